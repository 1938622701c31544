"""Plain versions of the pipeline's stages and of the decoding of secrets, one document or one node at a time."""

import base64
import bz2
import gzip
import hashlib
import lzma
import math
import re
import zlib
from collections import defaultdict

import zstandard

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VALUE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
RUN = VALUE - set(".=")
HEX = set("0123456789abcdefABCDEF")


def _assignment(t, i):
    """Where the value begins and ends if an assignment starts at ``i``."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t[i : i + 8])
    for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
        if not low.startswith(word):
            continue
        j = i + len(word)
        j += t[j : j + 1] in ('"', "'")
        while t[j : j + 1] == " ":
            j += 1
        if t[j : j + 1] not in (":", "="):
            return None
        j += 1
        while t[j : j + 1] == " ":
            j += 1
        j += t[j : j + 1] in ('"', "'")
        k = j
        while k < len(t) and t[k] in VALUE:
            k += 1
        return (j, k) if k > j else None
    return None


def _stretches(t, letters, least):
    i = 0
    while i < len(t):
        j = i
        while j < len(t) and t[j] in letters:
            j += 1
        if j - i >= least:
            yield i, j
        i = max(j, i + 1)


def base_secrets(t):
    found, i = [], 0
    while i < len(t):
        at = _assignment(t, i)
        if at and at[1] - at[0] >= 6:
            found.append(("assign", i, at[1]))
        i = at[1] if at else i + 1
    while (i := t.find("AKIA", 0 if not found or found[-1][0] != "access" else i)) >= 0:
        j = i + 4
        while j < len(t) and t[j] in "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789":
            j += 1
        found += [("access", i, j)] if j - i >= 20 else []
        t = t[:i] + "_" * (j - i) + t[j:]  # done with these
        i = 0
    return found


def secrets_of(t):
    return base_secrets(t) + [("hex", a, b) for a, b in _stretches(t, set("0123456789abcdef"), 24)]


def _told(data):
    """Characters of bytes with the numbers of their first byte and of the one after their last."""
    try:
        out, at = [], 0
        for c in data.decode("utf-8"):
            out.append((c, at, at + len(c.encode())))
            at += len(c.encode())
        return out
    except UnicodeDecodeError:
        return [(chr(b), k, k + 1) for k, b in enumerate(data)]


def _percent_decoded(chars):
    t, out, i, changed = "".join(c[0] for c in chars), [], 0, False
    while i < len(t):
        j = i
        while t[j : j + 1] == "%" and len(t) >= j + 3 and set(t[j + 1 : j + 3]) <= HEX:
            j += 3
        if j == i:
            out.append(chars[i])
            i += 1
            continue
        data = bytes(int(t[k + 1 : k + 3], 16) for k in range(i, j, 3))
        out += [(c, chars[i + 3 * a][1], chars[i + 3 * b - 1][2]) for c, a, b in _told(data)]
        i, changed = j, True
    return out if changed else None


def _escapes_decoded(chars):
    t, out, i, changed = "".join(c[0] for c in chars), [], 0, False
    while i < len(t):
        n = {"\\u": 6, "\\x": 4}.get(t[i : i + 2], 0)
        if not n or len(t) < i + n or not set(t[i + 2 : i + n]) <= HEX:
            out.append(chars[i])
            i += 1
            continue
        out.append((chr(int(t[i + 2 : i + n], 16)), chars[i][1], chars[i + n - 1][2]))
        i, changed = i + n, True
    return out if changed else None


def _opened(data):
    for head, tool in ((b"\x1f\x8b", gzip.decompress), (b"BZh", bz2.decompress), (b"\xfd7zXZ", lzma.decompress), (b"\x28\xb5\x2f\xfd", lambda x: zstandard.ZstdDecompressor().stream_reader(x).read()), (b"\x78", zlib.decompress)):
        if data.startswith(head):
            try:
                return tool(data)
            except (OSError, EOFError, zlib.error, lzma.LZMAError, zstandard.ZstdError, ValueError):
                return None
    return None


def _base64_decoded(chars):
    t = "".join(c[0] for c in chars)
    for i, j in _stretches(t, RUN, 16):
        body, end = t[i:j].replace("-", "+").replace("_", "/"), j
        while end < min(len(t), j + 2) and t[end] == "=":
            end += 1
        body = body[: len(body) - (len(body) % 4 == 1)]
        data = base64.b64decode(body + "=" * (-len(body) % 4))
        inner = data
        while (inner := _opened(inner)) is not None:
            yield [(c, chars[i][1], chars[end - 1][2]) for c, _, _ in _told(inner)]
        yield [(c, chars[i + a * 4 // 3][1], chars[min(i + (b - 1) * 4 // 3 + 1, end - 1)][2]) for c, a, b in _told(data)]


def secret_spans(text):
    """All spans of a text without wrapped lines, by recursion over its layers."""
    found, seen = set(), set()

    def look(chars):
        t = "".join(c[0] for c in chars)
        if not t or (t, chars[0][1]) in seen:
            return
        seen.add((t, chars[0][1]))
        found.update((kind, min(x[1] for x in chars[a:b]), max(x[2] for x in chars[a:b])) for kind, a, b in secrets_of(t))
        for below in (_percent_decoded(chars), _escapes_decoded(chars), *_base64_decoded(chars)):
            if below is not None:
                look(below)

    look([(c, k, k + 1) for k, c in enumerate(text or "")])
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0]), s[2]))


def without_secrets(text, mark="[secret]"):
    hidden = [False] * len(text)
    starts = set()
    for a, b in sorted((a, b) for _, a, b in secret_spans(text)):
        starts |= set() if hidden[a] else {a}
        hidden[a:b] = [True] * (b - a)
    return "".join(mark * (k in starts) + ("" if hidden[k] else c) for k, c in enumerate(text))


def good(docs, common):
    """Ids of the documents that the rules and distances keep; ``common`` lists words by language."""
    patterns = ["[A-Z]", "[0-9]", "[#*$%&|<>]", r"[.,;:!?'\"()\[\]{}/_=+@~^`\\-]", r"[^\x00-\x7F]", r"[\x20\x09-\x0D]"]
    shapes, sums = {}, {}
    for d in docs:
        t, lang = d["text"] or "", d["lang"] if d["lang"] in common else ""
        words = WORD.findall(t)
        chars = [len(re.findall(p, t)) for p in patterns]
        hits = [words.count(w) for w in common.get(lang, [])]
        shapes[d["doc_id"]] = lang, [*chars, len(t) - sum(chars)], [*hits, len(words) - sum(hits)], words, len(t)
        for which in (1, 2):
            own = shapes[d["doc_id"]][which]
            sums[lang, which] = [a + b for a, b in zip(own, sums.get((lang, which), [0] * len(own)), strict=True)]

    def far(one, which):
        own, ref = one[which], sums[one[0], which]
        p, q = [x / sum(own) for x in own], [x / sum(ref) for x in ref]
        half = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b, strict=True) if x) / 2
        return math.sqrt(max(0.0, half(p, q) + half(q, p)))

    kept = set()
    for i, one in shapes.items():
        words = one[3]
        places = defaultdict(list)
        for k in range(len(words) - 4):
            places[tuple(words[k : k + 5])].append(k)
        twice = {k + x for at in places.values() if len(at) > 1 for k in at for x in range(5)}
        odd = (one[4] >= 200 and far(one, 1) > 0.34) or (len(words) >= 50 and far(one, 2) > 0.45)
        if len(words) >= 10 and 100 * len(twice) <= 20 * len(words) and not odd:
            kept.add(i)
    return kept


def dealt(budget, caps, weights):
    """A budget dealt out by weights, none above its cap."""
    given, left, open_ = {}, budget, {n for n in caps if caps[n] > 0 and weights[n] > 0}
    while full := [n for n in open_ if caps[n] * sum(weights[x] for x in open_) <= weights[n] * left]:
        one = min(full, key=lambda n: (caps[n] / weights[n], n))
        given[one] = caps[one]
        left -= caps[one]
        open_.remove(one)
    return {**given, **{n: weights[n] * left // sum(weights[x] for x in open_) for n in open_}}


def mixture(docs, path_of, weights, share, seed="mix"):
    """id -> how often it is taken; ``path_of`` gives a document's names down the tree, ``weights`` are by level."""
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    leaves = defaultdict(list)
    for d in docs:
        leaves[path_of(d)].append(d)
    size = {d["doc_id"]: len(WORD.findall(d["text"] or "")) for d in docs}
    tokens = {p: sum(size[d["doc_id"]] for d in rows) for p, rows in leaves.items()}
    given = {(): min(int(sum(tokens.values()) * share), 2 * sum(tokens.values()))}
    for k, (_, by_name) in enumerate(weights):
        for parent in [p for p in given if len(p) == k]:
            caps = defaultdict(int)
            for p, n in tokens.items():
                if p[:k] == parent:
                    caps[p[k]] += 2 * n
            given.update({(*parent, n): g for n, g in dealt(given[parent], caps, {n: by_name.get(n, 1) for n in caps}).items()})
    taken = {}
    for p, rows in leaves.items():
        whole, rest = divmod(given.get(p, 0), tokens[p]) if tokens[p] else (0, 0)
        order = sorted((md5(f"{seed}:{whole + 1}:{d['doc_id']}:{md5(d['text'] or '')}"), d["doc_id"]) for d in rows)
        upto = 0
        for _, i in order:
            upto += size[i]
            taken[i] = whole + (rest > 0 and upto <= rest)
    return taken
