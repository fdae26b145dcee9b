"""The operators in plain Python, one document at a time, for the tests."""

import math
import re
import zlib
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
NUMBERS = re.compile(r"[0-9/_+-]+")
NAMES = re.compile(r"[a-z]+([/_-][a-z]+)+([/_-]?[0-9]{1,4})?")
PLACEHOLDER = re.compile(r"example|sample|dummy|placeholder|changeme|xxxx|0000000|your[_-]|abcdefgh|01234567|12345678|qwertyui", re.I)


def words(text):
    return WORD.findall(text.translate(LOWER))


def shingles(text):
    w = BLANK.findall(text.translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(texts):
    """A number for each text; texts have the same one if links join them."""
    sets = [shingles(t) for t in texts]
    label = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                label = [min(label[a], label[b]) if k in (label[a], label[b]) else k for k in label]
    return label


def one_of_each(rows):
    """Of (id, text) the rows that stay; of several texts of a component's smallest id, which one is open: all are given as a set."""
    label, sets = components([t or "" for _, t in rows]), [shingles(t or "") for _, t in rows]
    stay, choice = [], {}
    for (i, t), k, s in zip(rows, label, sets, strict=True):
        if i is None or not s:
            stay.append((i, t))
        else:
            choice.setdefault(k, []).append((i, t))
    return stay, [{(i, t) for i, t in group if i == min(x for x, _ in group)} for group in choice.values()]


def entropy(s, width):
    return max(-sum(n / width * math.log2(n / width) for n in Counter(s[i : i + width]).values()) for i in range(len(s) - width + 1))


def is_secret(s):
    if not re.search("[0-9]", s) or any(p.fullmatch(s) for p in (UUID, NUMBERS, NAMES)):
        return False
    for part in PLACEHOLDER.split(s):
        core = part.rstrip("=")
        if len(core) >= 20 and re.search("[0-9]", core) and re.search("[A-Za-z]", core):
            if entropy(core, 20) >= (3.1 if re.fullmatch("[0-9a-f]+|[0-9A-F]+", core) else 3.85) - 1e-12:
                return True
    return False


def base_spans(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def spans(text):
    base = base_spans(text)
    out = list(base)
    for m in re.finditer("[A-Za-z0-9+/_-]{20,}={0,2}", text):
        touching = sorted(b for b in base if b[0] < m.end() and m.start() < b[2])
        parts, at = [], m.start()
        for s, _, e, _ in touching:
            parts.append((at, s))
            at = max(at, e)
        for s, e in [*parts, (at, m.end())] if touching else [m.span()]:
            if (not touching or e - s >= 20) and is_secret(text[s:e]):
                out.append((s, 3, e, "entropy"))
    return sorted(out)


def told(found):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in found)


def redacted(text, marker="[SECRET]"):
    out, at, end = "", 0, 0
    for s, _, e, _ in spans(text):
        if s >= end:  # not within or over the one before
            out += text[at:s] + marker if s >= at else ""
        end = at = max(end, e)
    return out + text[at:]


def contaminated(text, items):
    """Hit words and items of a document; ``items``: (id, text)."""
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t or "") if item is not None else []
        k = min(10, len(b))
        windows = {tuple(b[i : i + k]) for i in range(len(b) - k + 1)} if b else set()
        for i in range(len(w) - k + 1) if windows else ():
            if tuple(w[i : i + k]) in windows:
                hit.update(range(i, i + k))
                found.add(str(item))
    return len(w), hit, found


def rooms(lengths, window):
    """Best fit decreasing: the room left in each sequence."""
    left = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(left) if r >= n]
        if fits:
            left[min(fits)[1]] -= n
        else:
            left.append(window - n)
    return left


def pieces(rows, tokenizer, window):
    out = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for s in range(0, len(ids), window):
            part = np.array(ids[s : s + window], "<u4")
            out.append((i, s, len(part), zlib.crc32(part.tobytes()), len(ids)))
    return out


def licences(text, rules, reach, mark):
    """Findings (start, end, label, priority, confidence) of a text that no other one holds, and its words. ``rules``: as the library has them."""
    w, found = words(text), []
    by_keyword = {}
    for rule in rules:
        by_keyword.setdefault(rule[0], []).append(rule)
    for i, word in enumerate(w):
        left, right = w[max(0, i - reach) : i], w[i + 1 : i + reach]
        said = "".join(f" {x}" for x in left) + f" {mark}{word} " + "".join(f"{x} " for x in right)
        for _, _, rule, label, priority, confidence in by_keyword.get(word, ()):
            m = re.search(f" {rule}(?= )", said)
            if m:
                start = i - m[0].split(mark)[0].count(" ") + 1
                found.append((start, start + m[0].count(" "), label, priority, confidence))

    def held(f):
        for g in found:
            within = g[0] <= f[0] and f[1] <= g[1]
            if within and (g[3] > f[3] or g[3] == f[3] and (g[1] - g[0] > f[1] - f[0] or g[1] - g[0] == f[1] - f[0] and g[2] < f[2])):
                return True
        return False

    top = max(r[4] for r in rules)
    return w, [f for f in found if f[3] == top or not held(f)]


M = (1 << 64) - 1


def mix(h):
    h ^= h >> 30
    h = h * 0xBF58476D1CE4E5B9 & M
    h ^= h >> 27
    h = h * 0x94D049BB133111EB & M
    return h ^ h >> 31


def word_hash(word):
    total = sum(mix((b + 1) * 0x9E3779B97F4A7C15 & M) * pow(0x2545F4914F6CDD1D, k, 1 << 64) for k, b in enumerate(word.encode()))
    return mix((total + len(word.encode())) & M)


def pair_hash(a, b):
    out = 2
    for h in (a, b):
        out = (out * 0x9E3779B97F4A7C15 + h) & M
        out ^= out >> 29
    return mix(out)


def logistic(x):
    return 1 / (1 + math.exp(-x))


def quality_score(model, text, scale):
    """The logistic of the sparse dot product, a word and a pair of words at a time."""
    found = [word_hash(m[0]) for m in re.finditer(r"[0-9A-Za-z\x80-\U0010FFFF]+|[!-/:-@\[-`{-~]+", text)]
    pairs = [1 if a == b else pair_hash(a, b) for a, b in zip(found, found[1:])]
    total = model.intercept
    for w, hashes in zip(model.weights, (found, pairs)):
        if hashes:
            total += scale * sum(float(w[h >> 64 - model.bits]) for h in hashes) / len(hashes)
    return logistic(total)


def toxicity_score(model, text):
    """The same over n-grams of code points."""
    values = [mix(ord(c) + 1) for c in text.translate(LOWER)]
    total = model.intercept
    for w, n in zip(model.weights, model.orders):
        grams = []
        for k in range(len(values) - n + 1):
            h = 0
            for v in values[k : k + n]:
                h = (h * 0x9E3779B97F4A7C15 + v) & M
            grams.append((h ^ h >> 31) * 0xD6E8FEB86659FD93 & M)
        if grams:
            total += sum(float(w[h >> 64 - model.bits]) for h in grams) / len(grams)
    return logistic(total)
