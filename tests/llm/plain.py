"""Plain-loop versions of the two trained operators, without the operators' own numpy code."""

import math

import numpy as np

STOP = ["the", "of", "and", "to", "in", "is", "de", "la", "le", "et", "les", "que", "der", "die", "und", "das", "ist", "el", "los", "en", "y", "un"]


def grams(text, n, bits):
    """Share denominator and counts of the hashed byte n-grams."""
    raw = b" " + (text or "").encode() + b" " * (n - 1)
    out = {}
    for i in range(len(raw) - n + 1):
        code = 0
        for b in raw[i : i + n]:
            code = (code * 0x01000193 & 0xFFFFFFFF) ^ b
        code = (code * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - bits)
        out[code] = out.get(code, 0) + 1
    return sum(out.values()), out


def repeated(text):
    w = (text or "").split()
    return sum(a == b for a, b in zip(w, w[1:])) / (len(w) - 1) if len(w) > 1 else 0.0


def votes(text):
    """The ten labellers' votes."""
    raw = text.encode()
    size, n = max(1, len(raw)), raw.count(b" ") + raw.count(b"\n") + 1
    letters = [b for b in raw if 65 <= b <= 90 or 97 <= b <= 122]
    upper = sum(65 <= b <= 90 for b in raw) / max(1, len(letters))
    plain = set(b" \t\r\n.,;:!?'\"()-0123456789")
    symbols = sum(b < 128 and not (65 <= b <= 90 or 97 <= b <= 122) and b not in plain for b in raw) / size
    lines = raw.split(b"\n")
    variety = len(set(lines)) / len(lines)
    words = text.split()
    distinct = len(set(words)) / max(1, len(words))
    function = sum(text.lower().count(f" {w} ") for w in STOP) / n
    length = size / n
    again = repeated(text)
    rules = [
        (symbols < 0.02, symbols > 0.06),
        (n >= 5 and upper < 0.2, n >= 5 and upper > 0.6),
        (n >= 5 and b"|" not in raw, n >= 5 and raw.count(b"|") / n > 0.15),
        (n >= 5 and raw.count(b"!") / n < 0.05, n >= 5 and raw.count(b"!") / n > 0.3),
        (len(lines) >= 4 and variety > 0.9, len(lines) >= 4 and variety < 0.5),
        (n >= 20 and raw.count(b".") / n > 0.02, n >= 60 and b"." not in raw),
        (n >= 5 and 3 < length < 10, n >= 5 and (length > 14 or length < 2.5)),
        (n >= 20 and function > 0.05, n >= 20 and function < 0.005),
        (n >= 5 and again < 0.05, n >= 5 and again > 0.3),
        (n >= 20 and distinct > 0.35, n >= 20 and distinct < 0.2),
    ]
    return [1 if good else -1 if bad else 0 for good, bad in rules]


def posteriors(rows, steps=200):
    """Probability of good of each row of votes, by expectation-maximisation row for row."""
    good = [0.02 if min(r) < 0 else 0.98 for r in rows]
    for _ in range(steps):
        share = min(max(sum(good) / max(len(good), 1e-9), 1e-3), 1 - 1e-3)
        log = []
        for k in (0, 1):
            belief = good if k else [1 - g for g in good]
            table = []
            for j in range(10):
                no = 1.0 + sum(b for b, r in zip(belief, rows) if r[j] < 0)
                yes = 1.0 + sum(b for b, r in zip(belief, rows) if r[j] > 0)
                table.append((math.log(no / (no + yes)), math.log(yes / (no + yes))))
            log.append([math.log((1 - share, share)[k]) + sum(table[j][r[j] > 0] for j in range(10) if r[j]) for r in rows])
        new = [1 / (1 + math.exp(min(700, max(-700, a - b)))) for a, b in zip(*log)]
        moved = max((abs(a - b) for a, b in zip(new, good)), default=0)
        good = new
        if moved < 1e-9:
            break
    return good


def quality_scores(texts, bits=12, shrink=200.0, epochs=60):
    """Score of each text, the scorer trained on all of them (at most 128) in whole batches."""
    known = [t for t in texts if t]
    target = posteriors([votes(t) for t in known])
    size = (1 << bits) + 1

    def shares(text):
        n, counts = grams(text, 3, bits)
        return {**{c: k / (n + shrink) for c, k in counts.items()}, size - 1: repeated(text)}

    rows = [shares(t) for t in known]
    scale = [1e4] * size
    for c in {c for r in rows for c in r}:
        values = [r.get(c, 0.0) for r in rows]
        mean = sum(values) / len(values)
        scale[c] = 1 / max(math.sqrt(sum((v - mean) ** 2 for v in values) / len(values)), 1e-4)
    scaled = [{c: v * scale[c] for c, v in r.items()} for r in rows]
    w, first, second = [0.0] * (size + 1), [0.0] * (size + 1), [0.0] * (size + 1)
    for t in range(1, epochs + 1 if rows else 1):
        slope = [1e-4 * x for x in w[:-1]] + [0.0]
        for r, y in zip(scaled, target):
            margin = sum(v * w[c] for c, v in r.items()) + w[-1]
            error = (1 / (1 + math.exp(-min(30, max(-30, margin)))) - y) / len(scaled)
            for c, v in r.items():
                slope[c] += error * v
            slope[-1] += error
        for c, g in enumerate(slope):
            first[c], second[c] = 0.9 * first[c] + 0.1 * g, 0.999 * second[c] + 0.001 * g * g
            w[c] -= 0.002 * (first[c] / (1 - 0.9**t)) / (math.sqrt(second[c] / (1 - 0.999**t)) + 1e-8)
    out = []
    for t in texts:
        margin = sum(v * scale[c] * w[c] for c, v in shares(t).items()) + w[-1] if t else 0
        out.append(1 / (1 + math.exp(-min(30, max(-30, margin)))) if t else 0.0)
    return out


def language_model(texts, labels, bits=12, dims=16, epochs=40, seed=5):
    """identify(text) -> (language, confidence) of a model trained on the texts, all sums as loops."""
    languages, size = sorted(set(labels)), 2 << bits

    def features(text):
        out = {}
        for k, n in enumerate((3, 4)):
            total, counts = grams((text or "").lower(), n, bits)
            out |= {(k << bits) + c: v / (total + 10.0) / 2 for c, v in counts.items()}
        return out

    def softmax(z):
        e = [math.exp(v - max(z)) for v in z]
        return [v / sum(e) for v in e]

    x, y, rng = [features(t) for t in texts], [languages.index(v) for v in labels], np.random.default_rng(seed)
    order = rng.permutation(len(x)).tolist()
    cut = int(len(order) * 0.25)
    held, fitted = order[:cut], order[cut:]
    table, layer, bias, rate = rng.normal(0, 0.1, (size, dims)).tolist(), rng.normal(0, 0.1, (dims, len(languages))).tolist(), [0.0] * len(languages), 4.0
    classes = range(len(languages))

    def hidden(r):
        h = [0.0] * dims
        for c, v in r.items():
            for d, e in enumerate(table[c]):
                h[d] += v * e
        return h

    def margins(r):
        h = hidden(r)
        return [sum(h[d] * layer[d][k] for d in range(dims)) + bias[k] for k in classes]

    for _ in range(epochs):
        for _ in range(0, len(fitted), 32):
            chosen = rng.choice(np.array(fitted), min(32, len(fitted)), replace=False).tolist()
            hs = [hidden(x[i]) for i in chosen]
            slopes = []
            for i, h in zip(chosen, hs):
                p = softmax([sum(h[d] * layer[d][k] for d in range(dims)) + bias[k] for k in classes])
                slopes.append([(p[k] - (y[i] == k)) / len(chosen) for k in classes])
            backs = [[sum(s[k] * layer[d][k] for k in classes) for d in range(dims)] for s in slopes]
            for h, s in zip(hs, slopes):
                for k in classes:
                    bias[k] -= 0.05 * rate * s[k]
                    for d in range(dims):
                        layer[d][k] -= 0.5 * rate * h[d] * s[k]
            for i, back in zip(chosen, backs):
                for c, v in x[i].items():
                    row = table[c]
                    for d in range(dims):
                        row[d] -= 20 * rate * v * back[d]
        rate *= 0.93
    scores = [(margins(x[i]), y[i]) for i in held]
    grid = [0.2 * 25 ** (i / 24) for i in range(25)]
    loss = [-sum(math.log(softmax([v / t for v in m])[k] + 1e-12) for m, k in scores) for t in grid]
    heat = grid[loss.index(min(loss))]
    sure = [softmax([v / heat for v in m]) for m, _ in scores]
    right = sorted(max(p) for p, (_, k) in zip(sure, scores) if p.index(max(p)) == k)
    least = max(1.5 / (len(languages) + 0.5), right[int(len(right) * 0.001)])

    def identify(text):
        if not any(c.isalpha() for c in text or ""):
            return "und", 0.0
        p = softmax([v / heat for v in margins(features(text))])
        return (languages[p.index(max(p))] if max(p) >= least else "und"), max(p)

    return identify
