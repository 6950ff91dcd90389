"""Row-by-row definitions of the indicators, for comparison on small data."""


def sma(values, n):
    out = []
    for i in range(len(values)):
        frame = [v for v in values[max(0, i - n + 1):i + 1] if v is not None]
        out.append(sum(frame) / len(frame) if frame else None)
    return out


def ema(values, n):
    out, current = [], None
    for v in values:
        if v is not None:
            current = v if current is None else current + 2 / (n + 1) * (v - current)
        out.append(current)
    return out


def change(values):
    return [None if i == 0 or values[i] is None or values[i - 1] is None else values[i] - values[i - 1]
            for i in range(len(values))]


def gain(values):
    return [d if d is not None and d > 0 else 0.0 for d in change(values)]


def loss(values):
    return [-d if d is not None and d < 0 else 0.0 for d in change(values)]


def rsi(values, n):
    out = []
    for up, down in zip(sma(gain(values), n), sma(loss(values), n)):
        out.append(100.0 if down == 0 else 100 - 100 / (1 + up / down))
    return out


def macd(values, fast=12, slow=26, signal=9):
    line = [None if f is None else f - s for f, s in zip(ema(values, fast), ema(values, slow))]
    sig = ema(line, signal)
    return line, sig, [None if m is None else m - s for m, s in zip(line, sig)]
