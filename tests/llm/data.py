"""Small fixtures and brute-force versions for the operators' tests."""

import hashlib
import random
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def awkward(n=40, seed=1):
    """(doc_id, text) with nulls, empty and long texts, ties, repeated rows,
    repeated ids, few words (so that much repeats) and odd characters."""
    rng = random.Random(seed)
    vocab = ["the", "of", "Alpha", "beta", "x1", "é", "日本", "a|b", "##", "end.", "the,"]
    long = " ".join(rng.choice(vocab) for _ in range(3000))
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 5, 30, 60])))) for i in range(n)]
    rows += [(100, None), (101, ""), (102, " \t\n "), (103, long), (104, long + " x1 x1"), (105, "a" * 3000),
             (106, "the " * 500), (None, "no id the of Alpha beta x1 the of"), (None, None), (107, "12 34 -- ##")]
    rows += [rows[3], rows[3], rows[-6], (5, "same id, other text " + rows[7][1])]
    rng.shuffle(rows)
    return rows


def frame(spark, rows, extra=True):
    """documents, with columns whose names the operators use inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    clash = ("k", "c", "n", "key", "fp", "size", "spans", "score", "component", "_d", "_h", "at", "label", "taken",
             "n_words", "held_out", "letters", "u", "v", "node", "first", "ctx", "items", "block",
             "__d", "__h", "__spans", "__copies", "__words", "__letters", "_fd", "_fh", "_letters", "_spans", "_copies",
             "_words")
    if extra:
        schema += "".join(f", {c} string" for c in clash)
    langs = [None, "en", "de"]
    out = [(i, t, langs[j % 3], None if j % 5 == 0 else f"s{j % 4}", len(t or ""), *(["z"] * len(clash) if extra else []))
           for j, (i, t) in enumerate(rows)]
    return spark.createDataFrame(out, schema)


def fingerprint(text):
    w = WORD.findall(lower(text))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    count = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            count[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * count[b] > len(grams))


def components_of(prints, radius=3):
    """Component number of each fingerprint, by comparing all with all."""
    fp = np.array(prints, np.uint64)
    label = np.arange(len(fp))
    changed = True
    while changed:
        changed = False
        for i in range(len(fp)):
            near = np.bitwise_count(fp ^ fp[i]) <= radius
            low = label[near].min()
            if (label[near] != low).any():
                label[near] = low
                changed = True
    return label


def distinct_documents(rows):
    """(id, text) once each, in the operators' document order."""
    seen = dict.fromkeys(rows)
    return list(seen)


def repeats(units_of, rows, window, every):
    """Removed unit positions of each distinct document.  With ``every`` False,
    the document order must not depend on text hashes (unique ids)."""
    docs = distinct_documents(rows)
    if not every:
        docs.sort(key=lambda r: (r[0] is not None, r[0]))
    starts = {}
    for d, (_, t) in enumerate(docs):
        u = units_of(t)
        for i in range(len(u) - window + 1):
            starts.setdefault(tuple(u[i:i + window]), []).append((d, i))
    gone = [set() for _ in docs]
    for places in starts.values():
        for d, i in places if every and len(places) > 1 else places[1:]:
            gone[d].update(range(i, i + window))
    return dict(zip(docs, gone, strict=True))


def sha(data):
    return hashlib.sha256(data).hexdigest()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


