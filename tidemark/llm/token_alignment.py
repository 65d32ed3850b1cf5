"""Cross-tokenizer alignment by diagonal run skipping.

Two tokenizers cut the same bytes.  Byte offsets where a token of each ends cut
the tokens into groups.  ``skip_runs`` finds them from the two arrays of token
ends: as long as ends agree at the present shift between the two indices, probes
of 1, 2, 4 ... places jump over the one-to-one stretch; at the first difference
the smaller end moves on until both meet again, which closes an irregular group
and updates the shift.  All lanes (stretches between known common ends) of a
slice of texts step together in numpy.

Texts are encoded in runs without a boundary that a tokenizer could look across
(see ``Pair.encode``), so a very long text is never encoded whole, and a run that
comes again is read from a bounded cache.  Both vocabulary files are read on the
driver and broadcast (a few MB; their paths are parameters).
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import text as tx
from tidemark.llm.common import arrow, table, written

FOLDER = "/opt/tokenizers"
BYTE_BPE = f"{FOLDER}/byte_bpe_50k.json"
PIECE_BPE = f"{FOLDER}/piece_bpe_32k.model"
#: Tokens of A between the starts of two lanes, and the longest probe.
LANE = 64
#: Pairs of ids whose counts are broadcast (24 bytes each); the others are joined.
COMMON_PAIRS = 1_000_000
#: Runs, and characters of runs, kept with their tokens in a Python worker.
CACHED_RUNS = 400_000
CACHED_CHARS = 8_000_000
#: Characters of new runs encoded at once.
_JOINED = 1 << 17


def byte_level() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable Latin-1 characters
    stand for themselves, the other bytes for U+0100 and on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


#: A space between two characters that no tokenizer's white space rule is in doubt
#: about, and one that isn't.
_CUT = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
_ODD = re.compile(r" (?:(?![!-~\w])|(?<![!-~\w] ))")


class Pair:
    """Both tokenizers: ids, and the bytes of every id."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        import sentencepiece
        import tokenizers
        self.a = tokenizers.Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        alphabet = byte_level()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else
                        self.b.id_to_piece(i).replace("▁", " ").encode() for i in range(self.b.get_piece_size())]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # pieces that hold white space behind another character could reach across runs
        self.by_runs = not any(" " in x.lstrip(b" ").decode("utf-8", "replace") for x in self.b_bytes)
        self._forget()

    def _forget(self) -> None:
        """An empty cache: number of a run (-1: its tokens don't give it back), and
        the tokens of run i from ``start[i]`` to ``start[i + 1]``, for A and B."""
        self.number: dict[str, int] = {}
        self.chars = 0
        self.ids = [np.empty(0, np.int32), np.empty(0, np.int32)]
        self.start = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def runs(self, text: str) -> list[str]:
        """The text cut at spaces.  A single space between two characters that
        aren't white space begins a token in A and in B, so what stands on either
        side is encoded alike on its own; at other spaces it isn't cut."""
        if not self.by_runs:
            return [text]
        return _CUT.split(text) if _ODD.search(text) else text.split(" ")

    def _learn(self, runs: list[str]) -> None:
        """Encode new runs, joined by spaces, and cut the tokens at their ends."""
        text = " ".join(runs)
        want = b" " + text.encode("utf-8", "replace")
        ids = [np.array(self.a.encode(" " + text, add_special_tokens=False).ids, np.int32),
               np.array(self.b.encode(text), np.int32)]
        same = all(b"".join(map(table.__getitem__, x.tolist())) == want
                   for x, table in zip(ids, (self.a_bytes, self.b_bytes), strict=True))
        ends = np.cumsum([1 + len(x.encode("utf-8", "replace")) for x in runs])
        token_ends = [np.cumsum(size[x]) for x, size in zip(ids, (self.a_size, self.b_size), strict=True)]
        if same and (len(runs) == 1 or all(np.isin(ends, x).all() for x in token_ends)):
            first = len(self.start[0]) - 1
            self.number.update((x, first + i) for i, x in enumerate(runs))
            for k in (0, 1):
                cut = np.searchsorted(token_ends[k], ends) + 1
                self.start[k] = np.concatenate([self.start[k], self.start[k][-1] + cut])
                self.ids[k] = np.concatenate([self.ids[k], ids[k]])
        elif len(runs) == 1:
            self.number[runs[0]] = -1
        else:
            self._learn(runs[:len(runs) // 2])
            self._learn(runs[len(runs) // 2:])

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and for B: the ids of all texts, and where each text's begin (and
        the last one's end).  A text whose tokens don't give it back has none."""
        runs = [self.runs(x) if x else [] for x in texts]
        flat = [x for r in runs for x in r]
        if len(self.number) > CACHED_RUNS or self.chars > CACHED_CHARS:
            self._forget()
        new = [x for x in dict.fromkeys(flat) if x not in self.number]
        size = np.cumsum([len(x) + 1 for x in new], dtype=np.int64)
        for block in np.split(np.arange(len(new)), np.flatnonzero(np.diff(size // _JOINED)) + 1):
            if len(block):
                self._learn(new[block[0]: block[-1] + 1])
        self.chars += int(size[-1]) if len(size) else 0
        at = np.fromiter(map(self.number.__getitem__, flat), np.int64, len(flat))
        text = np.repeat(np.arange(len(texts)), [len(r) for r in runs])
        whole = np.ones(len(texts), bool)
        whole[text[at < 0]] = False
        at, text = at[whole[text]], text[whole[text]]
        out = []
        for ids, start in zip(self.ids, self.start, strict=True):
            n = start[at + 1] - start[at]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[at], n)
            each = np.zeros(len(texts) + 1, np.int64)
            np.add.at(each, text + 1, n)
            out.append((ids[place], np.cumsum(each)))
        return out


# ------------------------------------------------------------------ groups

def _meet(ea: np.ndarray, eb: np.ndarray, p: np.ndarray, q: np.ndarray) -> None:
    """Move each (p, q) on, the smaller end first, to the next common end."""
    todo = np.flatnonzero(ea[p] != eb[q])
    while len(todo):
        x, y = ea[p[todo]], eb[q[todo]]
        p[todo] += x < y
        q[todo] += y < x
        todo = todo[ea[p[todo]] != eb[q[todo]]]


def skip_runs(ea: np.ndarray, eb: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """For increasing token ends with the same last one: whether each token of A
    and of B closes a group."""
    close_a, close_b = np.zeros(len(ea), bool), np.zeros(len(eb), bool)
    if not len(ea):
        return close_a, close_b
    # lanes: from the first common end at or behind every lane-th token
    p = np.arange(lane - 1, len(ea), lane)
    q = np.searchsorted(eb, ea[p])
    _meet(ea, eb, p, q)
    i, first = np.unique(np.concatenate([[0], p + 1]), return_index=True)
    j = np.concatenate([[0], q + 1])[first]
    stop = np.append(i[1:], len(ea))
    live = np.flatnonzero(i < stop)
    while len(live):
        odd, probing, width = [], live, 1
        while len(probing):  # the shift holds: probe twice as far
            a, b = i[probing], j[probing]
            at = np.arange(width)
            room = at < (stop[probing] - a)[:, None]
            x = np.minimum(a[:, None] + at, len(ea) - 1)
            y = np.minimum(b[:, None] + at, len(eb) - 1)
            same = (ea[x] == eb[y]) | ~room
            run = np.where(same.all(axis=1), width, same.argmin(axis=1))
            hit = (at < run[:, None]) & room
            close_a[x[hit]] = True
            close_b[y[hit]] = True
            step = np.minimum(run, stop[probing] - a)
            i[probing] += step
            j[probing] += step
            odd.append(probing[run < width])
            probing = probing[(run == width) & (i[probing] < stop[probing])]
            width = min(2 * width, lane)
        live = np.concatenate(odd)
        if len(live):  # irregular groups: resolved where they are, the shift changes
            p, q = i[live], j[live]
            _meet(ea, eb, p, q)
            close_a[p] = close_b[q] = True
            i[live], j[live] = p + 1, q + 1
            live = live[i[live] < stop[live]]
    return close_a, close_b


def overlaps(ea: np.ndarray, eb: np.ndarray, close_a: np.ndarray, close_b: np.ndarray):
    """(token of A, token of B) of all pairs whose byte ranges overlap: the only
    pair of a one-to-one group; in the others, ends are compared."""
    single_a = close_a & np.concatenate([[True], close_a[:-1]])
    single_b = close_b & np.concatenate([[True], close_b[:-1]])
    last_a, last_b = np.flatnonzero(close_a), np.flatnonzero(close_b)
    one = single_a[last_a] & single_b[last_b]
    group = np.cumsum(close_a) - close_a
    rest = np.flatnonzero(~one[group]) if len(group) else np.empty(0, np.int64)
    start = np.where(rest > 0, ea[rest - 1], 0)
    lo = np.searchsorted(eb, start, "right")
    n = np.searchsorted(eb, ea[rest], "left") - lo + 1
    y = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return np.concatenate([last_a[one], np.repeat(rest, n)]), np.concatenate([last_b[one], y])


class Slice:
    """The alignment of a slice of texts, end to end."""

    def __init__(self, pair: Pair, texts: list[str]):
        (self.a, self.a_cut), (self.b, self.b_cut) = pair.encode(texts)
        self.a_end, self.b_end = np.cumsum(pair.a_size[self.a]), np.cumsum(pair.b_size[self.b])
        self.close_a, self.close_b = skip_runs(self.a_end, self.b_end)
        closed = np.concatenate([[0], np.cumsum(self.close_a)])
        self.groups = np.diff(closed[self.a_cut])

    def group_text(self, names: list[str]) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text; ``names`` as by ``_names``."""
        half, n_a, n_b = len(self.a), np.flatnonzero(self.close_a), np.flatnonzero(self.close_b)
        in_a = np.cumsum(self.close_a) - self.close_a  # number of a token's group
        in_b = np.cumsum(self.close_b) - self.close_b
        order = np.empty(half + len(self.b), np.int64)
        before_b = np.concatenate([[0], n_b + 1])
        order[np.arange(half) + before_b[in_a]] = 2 * self.a.astype(np.int64) + self.close_a
        order[np.arange(len(self.b)) + (n_a + 1)[in_b]] = names[0] + 2 * self.b.astype(np.int64) + self.close_b
        cut = self.a_cut + self.b_cut
        return ["".join([names[1][x] for x in order[s:e].tolist()])[:-1]
                for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, id of A, id of B) of every link."""
        x, y = overlaps(self.a_end, self.b_end, self.close_a, self.close_b)
        return np.searchsorted(self.a_cut, x, "right") - 1, self.a[x], self.b[y]


def _names(pair: Pair) -> tuple[int, list[str]]:
    """Where B's names begin, and the text of 2 * id + closes its group."""
    a, b = len(pair.a_bytes), len(pair.b_bytes)
    return 2 * a, [f"{i}{s}" for i in range(a) for s in ",|"] + [f"{i}{s}" for i in range(b) for s in ",;"]


def _texts(column: pa.Array) -> list[str]:
    """A null is empty; bytes that aren't UTF-8 become U+FFFD, so that no text with
    such bytes agrees with its tokens."""
    return [x.decode("utf-8", "replace") if x else "" for x in column.cast(pa.binary()).to_pylist()]


@lru_cache(maxsize=1)
def _tokenizers(a_file: bytes, b_file: bytes) -> Pair:
    """Kept, with its cache, for a worker's next tasks."""
    return Pair(a_file, b_file)


def _pair(sent) -> Pair:
    return _tokenizers(*sent.value)


def _lists(values: np.ndarray, cut: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(values, kind))


def _files(spark: SparkSession, *paths: str):
    out = []
    for path in paths:
        with open(path, "rb") as f:
            out.append(f.read())
    return spark.sparkContext.broadcast(tuple(out))


def align(docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECE_BPE) -> DataFrame:
    """``doc_id, a_ids, b_ids, a_ends, b_ends`` for each row of ``docs``: the ids
    of space + text by A and of text by B, and for each group the number of tokens
    of A, and of B, up to its end.  Nulls and the rest as in ``link_counts``."""
    sent = _files(docs.sparkSession, a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(sent)
        for batch in batches:
            for part in tx.slices(batch, "text"):
                s = Slice(pair, _texts(part.column(1)))
                cut = np.concatenate([[0], np.cumsum(s.groups)])
                end_a, end_b = np.flatnonzero(s.close_a) + 1, np.flatnonzero(s.close_b) + 1
                yield pa.RecordBatch.from_arrays([
                    part.column(0), _lists(s.a, s.a_cut, pa.int32()), _lists(s.b, s.b_cut, pa.int32()),
                    _lists(end_a - np.repeat(s.a_cut[:-1], s.groups), cut, pa.int32()),
                    _lists(end_b - np.repeat(s.b_cut[:-1], s.groups), cut, pa.int32()),
                ], ["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])
    return arrow(docs.select("doc_id", "text"), run, f"doc_id {docs.select('doc_id').dtypes[0][1]}, a_ids array<int>, "
                 "b_ids array<int>, a_ends array<int>, b_ends array<int>")


# ------------------------------------------------------------------ links

def _linker(sent):
    """Per text: the counts, the digest, and its distinct links (id of A times
    the size of B plus id of B) with the number of times each is there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(sent)
        names, size = _names(pair), len(pair.b_bytes)
        for batch in batches:
            for part in tx.slices(batch, "text"):
                n = part.num_rows
                s = Slice(pair, _texts(part.column(1)))
                text, a, b = s.links()
                base = np.int64(len(pair.a_bytes) * size)
                code, times = np.unique(text * base + a.astype(np.int64) * size + b, return_counts=True)
                cut = np.searchsorted(code, np.arange(n + 1) * base)
                digest = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in s.group_text(names)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.diff(s.a_cut)), pa.array(np.diff(s.b_cut)),
                    pa.array(s.groups, pa.int64()), pa.array(np.bincount(text, minlength=n).astype(np.int64)),
                    pa.array(digest, pa.string()), _lists(code % base, cut, pa.int64()),
                    _lists(times.astype(np.int32), cut, pa.int32()),
                ], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pair", "times"])
    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a batch, counted, so that fewer rows are shuffled."""
    for batch in batches:
        pair, times = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (0, 1))
        known, where = np.unique(pair, return_inverse=True)
        n = np.zeros(len(known), np.int64)
        np.add.at(n, where, times)
        yield pa.RecordBatch.from_arrays([pa.array(known, pa.int64()), pa.array(n)], ["pair", "n"])


def pair_counts(links: DataFrame, b_size: int) -> DataFrame:
    """``pair, count, best``: how many links of the corpus hold a pair of ids, and
    whether no pair of its id of B has more."""
    counts = written(arrow(links.select("pair", "times"), _merged, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("count")), "token-pairs")
    b = F.col("pair") % b_size
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))  # at most b_size rows
    return counts.join(F.broadcast(most), b == F.col("b")).select(
        "pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _common(counts: DataFrame, bound: int):
    """The least power of two that at most ``bound`` pairs reach in count."""
    bits = counts.groupBy(F.length(F.bin("count")).alias("bits")).count().collect()  # at most 64 rows
    least, total = 64, 0
    for bit, n in sorted(((r["bits"], r["count"]) for r in bits), reverse=True):
        total += n
        if total > bound:
            break
        least = bit
    return min(2 ** (least - 1), 2 ** 63 - 1)


def _scorer(sent):
    """Sums over a text's links with broadcast counts; the other links go on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = sent.value
        for batch in batches:
            names = batch.schema.names
            lists = batch.column(names.index("pair"))
            pair = lists.flatten().to_numpy(zero_copy_only=False)
            times = batch.column(names.index("times")).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            found = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            total, top = np.zeros(len(lists), np.int64), np.zeros(len(lists), np.int64)
            f = at[found]
            np.add.at(total, row[found], times[found] * count[f])
            np.add.at(top, row[found], times[found] * best[f])
            rest = np.concatenate([[0], np.cumsum(np.bincount(row[~found], minlength=len(lists)))])
            keep = [i for i, x in enumerate(names) if x not in ("pair", "times")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(top), pa.array(total),
                 _lists(pair[~found], rest, pa.int64()), _lists(times[~found], rest, pa.int64())],
                [*(names[i] for i in keep), "n_best", "count_sum", "pair", "times"])
    return run


def link_counts(docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECE_BPE,
                common_pairs: int = COMMON_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``
    for each row of ``docs``.

    A null or empty text, and one whose tokens don't give back space + text (as B
    may change characters), has no tokens: zeros and an empty digest.  Each row
    counts, also one that repeats another.  ``doc_id`` may be of any type and null;
    other columns are not read; an empty table gives no rows.

    Links are written once with the texts' digests.  The counts of the commonest
    pairs (``common_pairs`` at most) are broadcast; links with other pairs meet
    their counts in a join, so that any number of pairs is counted exactly.
    """
    spark = docs.sparkSession
    sent = _files(spark, a_path, b_path)
    b_size = len(_pair(sent).b_bytes)
    kind = docs.select("doc_id").dtypes[0][1]
    rows = arrow(docs.select("doc_id", "text"), _linker(sent),
                 f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                 "pair array<long>, times array<int>")
    links = written(rows.withColumn("row", F.monotonically_increasing_id()), "token-links")
    counts = written(pair_counts(links, b_size), "token-pair-ranks")
    least = _common(counts, common_pairs)
    known = counts.where(F.col("count") >= least).toPandas().sort_values("pair")
    hot = spark.sparkContext.broadcast((known["pair"].to_numpy(np.int64), known["count"].to_numpy(np.int64),
                                        known["best"].to_numpy(np.int64)))
    scored = written(arrow(links, _scorer(hot), ", ".join(
        f"{n} {t}" for n, t in links.dtypes if n not in ("pair", "times")) +
        ", n_best long, count_sum long, pair array<long>, times array<long>"), "token-scores")
    rest = scored.select("row", F.explode(F.arrays_zip("pair", "times")).alias("l")).select("row", "l.pair", "l.times")
    more = rest.join(counts.where(F.col("count") < least), "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("count")).alias("more"),
        F.sum(F.col("times") * F.col("best").cast("long")).alias("more_best"))
    return scored.drop("pair", "times").join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_counts(table(spark, sf_dir, "documents"))
