"""Plain re-statements of the operators for small tables, one document or one
pair at a time."""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections import Counter
from html import unescape

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def simhash(text, k=4, seed=42):
    w = words(lower_ascii(text))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + k]).encode(), seed) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=4):
    """{id: smallest id reachable} from {id: fingerprint}."""
    parent = {i: i for i in prints}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(prints)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in ids}


def cut_repeats(docs, window=50):
    """{id: (n_words, n_removed, kept text)} from {id: text}."""
    first = {}
    for i in sorted(docs):
        w = words(docs[i])
        for p in range(len(w) - window + 1):
            first.setdefault(tuple(w[p:p + window]), i)
    out = {}
    for i, text in docs.items():
        w = words(text)
        gone = {q for p in range(len(w) - window + 1) if first[tuple(w[p:p + window])] < i for q in range(p, p + window)}
        out[i] = (len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone))
    return out


def plain_words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", lower_ascii(text))


def shingles(w, k=5):
    return [tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))] if w else []


def leaks(docs, items, threshold=0.8):
    """{(doc, item): (best similarity, its first word)}."""
    out = {}
    for item, text in items.items():
        want = plain_words(text)
        if not want:
            continue
        k = min(5, len(want))
        x = shingles(want, k)
        cx = Counter(x)
        for doc, body in docs.items():
            w = plain_words(body)
            if len(w) < k:
                continue
            s = shingles(w, k)
            n = min(len(x), len(s))
            best = (0.0, 0)
            for p in range(len(s) - n + 1):
                both = sum((Counter(s[p:p + n]) & cx).values())
                if both / (n + len(x) - both) > best[0]:
                    best = (both / (n + len(x) - both), p)
            if best[0] >= threshold:
                out[doc, item] = best
    return out


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def secrets(text):
    """Base spans (kind, start, end) by start, then kind."""
    text, out = text or "", []
    keyword = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
                         r"""[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out += [(m.start(), 0, m.end()) for m in keyword.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(out)]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def repeat_words(text, n=8):
    w = words(text)
    count = Counter(tuple(w[p:p + n]) for p in range(len(w) - n + 1))
    return len({q for p in range(len(w) - n + 1) if count[tuple(w[p:p + n])] > 1 for q in range(p, p + n)})


def html(page: str) -> str:
    """Text of a page of paragraphs, headings, flat lists and other blocks,
    by substitutions on the markup."""
    page = re.sub(r"(?s)<!--.*?-->|<!doctype[^>]*>", "", page, flags=re.I)
    page = re.sub(r"(?is)<(head|script|style)\b.*?</\1\s*>", "", page)
    page = re.sub(r"[ \t\n\r\f\v]+", " ", page)
    page = re.sub(r"(?i)</?(p|h1|ul)\b[^>]*>", "\n\n", page)
    page = re.sub(r"(?i)<li\b[^>]*>", "\n- ", page)
    page = re.sub(r"(?i)</?(html|body|nav|div|article|footer)\b[^>]*>|</li\s*>|<br\b[^>]*>", "\n", page)
    page = unescape(re.sub(r"<[^>]*>", "", page))
    lines = [re.sub(" +", " ", line).strip(" ") for line in page.split("\n")]
    # an empty line stays where two are asked for: around lists, not within
    text = re.sub(r"\n(?:\n)+(- )", r"\n\n\1", "\n".join(lines))
    text = re.sub(r"(?m)(^- .*)\n\n+(?=- )", r"\1\n", text)
    return re.sub(r"\n{3,}", "\n\n", text).strip("\n")


def random_tokens(text):
    """(start, end, stratum, p-value) of the tokens that could be keys: runs
    of one alphabet in longer runs of base64 characters, symbol by symbol."""
    text = text or ""
    plain, std, url = set(string.ascii_letters + string.digits), set("+/"), set("-_")
    orders = [string.digits + "abcdef", string.ascii_uppercase + "234567", string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/",
              string.ascii_uppercase + string.ascii_lowercase + string.digits + "-_"]
    out = []
    for begin, end in _runs(text, plain | std | url):
        tail = end
        while tail < len(text) and text[tail] == "=" and tail < end + 2:
            tail += 1
        for lo, hi in {run for marks in (std, url, set()) for run in _runs(text[:end], plain | marks, begin)}:
            token = text[lo:hi]
            if not set(token) & set(string.ascii_letters):
                continue
            kind = 0 if not set(token) - set("0123456789abcdef") or not set(token) - set("0123456789ABCDEF") else \
                next(k for k in (1, 2, 3) if not set(token) - set(orders[k]))
            symbols = [orders[kind].index(c.lower() if kind == 0 else c) for c in token]
            length = max(i for i, low in enumerate((16, 24, 40, 80)) if len(token) >= low)
            stratum = 4 * (2 * kind + (not set(token) & set(string.digits))) + length
            out.append((lo, tail if hi == end else hi, stratum, _battery(symbols, len(orders[kind]))))
    return out


def _runs(text, chars, begin=0):
    out, at = [], begin
    while at < len(text):
        end = at
        while end < len(text) and text[end] in chars:
            end += 1
        if end - at >= 16:
            out.append((at, end))
        at = max(end, at + 1)
    return out


def _battery(symbols, size):
    n = len(symbols)
    normal = lambda z: math.erfc(z / math.sqrt(2)) / 2
    bins = min(size, max(2, n // 4))
    chi2 = 0.0
    for b in range(bins):
        expected = n * sum(s * bins // size == b for s in range(size)) / size
        chi2 += (sum(s * bins // size == b for s in symbols) - expected) ** 2 / expected
    spread = 2 / (9 * (bins - 1))
    uniform = normal(((chi2 / (bins - 1)) ** (1 / 3) - 1 + spread) / math.sqrt(spread)) if chi2 > 0 else 1.0
    high = [2 * s >= size for s in symbols]
    a, b = sum(high), n - sum(high)
    if a and b:
        runs = 1 + sum(x != y for x, y in zip(high, high[1:]))
        var = 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
        run = 2 * normal(abs(runs - 1 - 2 * a * b / n) / math.sqrt(max(var, 1e-9)))
    else:
        run = 2.0 ** (1 - n)
    mean = sum(symbols) / n
    power = sum((s - mean) ** 2 for s in symbols)
    serial = sum((x - mean) * (y - mean) for x, y in zip(symbols, symbols[1:])) / power if power else 1.0
    half = -sum(math.log(max(p, 1e-300)) for p in (uniform, run, 2 * normal(abs(serial + 1 / n) * math.sqrt(n))))
    return math.exp(-half) * (1 + half + half ** 2 / 2)


def all_secrets(texts, max_false=0.1):
    """All spans of each text, by start, then kind: the base ones, and the
    tokens whose p-value reaches the cut-off of their stratum."""
    tokens = [random_tokens(text) for text in texts]
    by_stratum = {}
    for found in tokens:
        for _, _, stratum, p in found:
            by_stratum.setdefault(stratum, []).append(min(int(p * 100), 99))
    cuts = {}
    for stratum, at in by_stratum.items():
        keys = min(2 * sum(b >= 50 for b in at), len(at))
        for t in range(1, 100):
            above = sum(b >= t for b in at)
            if above and max(above - keys * (1 - t / 100), 0) / above <= max_false:
                cuts[stratum] = t / 100
                break
    out = []
    for text, found in zip(texts, tokens):
        base = secrets(text)
        picked = {(s, e) for s, e, stratum, p in found if stratum in cuts and p >= cuts[stratum]}
        inside = lambda span, others: any(o != span and o[0] <= span[0] and span[1] <= o[1] for o in others)
        known = {(s, e) for _, s, e in base}
        extra = [("random", s, e) for s, e in picked if (s, e) not in known and not inside((s, e), known) and not inside((s, e), picked)]
        order = ("assign", "access", "hex", "random")
        out.append(sorted(base + extra, key=lambda x: (x[1], order.index(x[0]), x[2])))
    return out


_MASK = (1 << 64) - 1


def _mixed(x):
    for _ in range(2):
        x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & _MASK
    return x ^ x >> 32


def fault_features(text):
    """Feature numbers of a text for the classifier: words, beginnings of
    words, steps of the measures."""
    data, w = (text or "").encode(), (text or "").encode().split()
    letters = [c for c in data if 65 <= c <= 90 or 97 <= c <= 122]
    marks = set(b"#*$%&|<>!")

    def repeats(n):
        grams = [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]
        return (len(grams) - len(set(grams))) / max(len(grams), 1)

    measures = [sum(c in marks for c in data) / max(len(data), 1), sum(x[-1] in marks for x in w) / max(len(w), 1),
                sum(0x20 < c < 0x7F and not chr(c).isalnum() for c in data) / max(len(data), 1),
                sum(c <= 90 for c in letters) / max(len(letters), 1), sum(x == y for x, y in zip(w, w[1:])) / max(len(w), 1), repeats(3), repeats(8)]
    out = {(1 << 30) + 10 * m + k - 1 for m, share in enumerate(measures) for k in range(1, 10) if share >= (k / 10) * (k / 10)}
    for word in set(re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), data))):
        out.add(_mixed(sum((c + 1) * pow(0x9E3779B97F4A7C15, i, 1 << 64) for i, c in enumerate(word)) & _MASK) >> 34)
        if len(word) > 6:
            out.add((1 << 31) + (_mixed(int.from_bytes(word[:6], "big")) >> 34))
    return out


def logistic(features, ids, weights, bias):
    logit = bias + sum(weight for i, weight in zip(ids, weights) if i in features)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))
