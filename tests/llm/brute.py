"""Plain versions of the corpus queries for small tables: rows are dicts."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

SPACE = r"[^\x20\x09-\x0D]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def encode(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [[*e.ids, 1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check_packing(docs, pieces, length=2048):
    """Every id in exactly one piece; sequences without gaps and full, but for the last."""
    want = dict(zip([d["doc_id"] for d in docs], encode([d["text"] for d in docs]), strict=True))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    assert set(by_doc) == set(want)
    for k, ids in want.items():
        at = 0
        for p in sorted(by_doc[k], key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0 and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[at : at + p["length"]]))
            at += p["length"]
        assert at == len(ids)
    sizes = []
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        sizes.append(at)
    assert max(sizes) <= length and sum(s < length for s in sizes) <= 1
    return by_seq


def shingles(text, size):
    w = re.findall(SPACE, lower(text))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def near_duplicates(docs, size, percent):
    sets = {d["doc_id"]: shingles(d["text"], size) for d in docs}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    p, q = sorted((find(a), find(b)))
                    root[q] = p
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def secret_spans(text):
    text = text or ""
    out = []
    for k, (kind, pattern, group, least) in enumerate((
        ("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        ("access", r"AKIA[A-Z0-9]+", 0, 18),
        ("hex", r"[0-9a-f]+", 0, 16),
    )):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return [s for _, _, s in sorted(out)]


def drop_repeats(docs, length):
    first = {}
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        t = (d["text"] or "").encode()
        for i in range(len(t) - length + 1):
            first.setdefault(t[i : i + length], d["doc_id"])
    out = {}
    for d in docs:
        t = (d["text"] or "").encode()
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if first[t[i : i + length]] < d["doc_id"]:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out[d["doc_id"]] = (len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def drop_passages(docs, length):
    words = {d["doc_id"]: re.findall(SPACE, d["text"] or "") for d in docs}
    first = {}
    for k in sorted(words):
        for i in range(len(words[k]) - length + 1):
            first.setdefault(tuple(words[k][i : i + length]), k)
    out = {}
    for k, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < k:
                gone[i : i + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[k] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def contamination(docs, items, length=13):
    windows = defaultdict(set)
    for b in items:
        w = re.findall(WORD, lower(b["text"]))
        for i in range(max(len(w) - length, 0) + 1 if w else 0):
            windows[tuple(w[i : i + length])].add(b["item_id"])
    sizes = {len(w) for w in windows}
    out = {}
    for d in docs:
        w = re.findall(WORD, lower(d["text"]))
        hit, found = [False] * len(w), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    found |= windows[tuple(w[i : i + n])]
                    hit[i : i + n] = [True] * n
        h = sum(hit)
        names = ",".join(sorted(map(str, found)))
        out[d["doc_id"]] = (len(w), h, len(found), hashlib.sha256(names.encode()).hexdigest(), h > 0 and 20 * h >= len(w))
    return out
