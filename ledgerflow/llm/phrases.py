"""Phrase collocations counted in burst tries, spilled as sorted runs.

1. Every word occurrence enters a task's trie once, with the two words that
   follow it in its piece: the trie's path is the first word, its hash
   container maps the rest to a count.  A container of more than ``BURST``
   entries bursts into containers one word deeper.  Counts of shorter
   phrases are the sums of their subtrees.
2. Beyond ``ENTRIES`` entries the largest subtrees of the trie are spilled
   whole, until half is left: as sorted runs of (phrase, count), one per
   prefix partition.  The partition comes from a phrase's prefix, and for the
   longest phrases also from one of ``SALTS`` classes of the last word, so
   that the subtree of a hot prefix is not one task's load.
3. The runs of a partition are merged in order, a bounded slice of all of
   them at a time.  Only phrases with ``LEAST`` occurrences go on: a part of a
   phrase occurs at least as often as the phrase.  Most phrases are rare and
   are never merged: occurrences are first added up by slots of hashes, whose
   sums bound those of their phrases.
4. Scores are exact integers of up to 38 digits, joined and ranked by Spark.

A task holds ``ENTRIES`` entries and ``WORDS`` words at most besides one
batch; a merging task holds its partition's compressed runs.

Words are bytes other than blank and tab within pieces cut at
``[.,;:!?]`` and U+000A..U+000D, A-Z in lower case.

Defined results: a null or empty text has no words; a null lang is ``und``.
Texts of any length are read whole.  Repeated rows count as often as they
occur, whatever their id.  Ties in score and count are ranked by the bytes
of the phrase.  Columns other than the text and the lang are ignored.  An
empty table gives an empty result.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small_batches, stage, text_or_empty, trim_memory, trimmed
from .texthash import joined_hashes

LEAST = 10
TOP = 2000
HALF = 50              # percent of a phrase's count that makes a longer one absorb it
BURST = 1 << 12        # entries of a container before it bursts
ENTRIES = 1 << 18      # entries of a trie before subtrees are spilled
WORDS = 1 << 17        # words of a task's dictionary before all is spilled
BITS = 21              # of a word's rank in a run
LAST = (1 << BITS) - 1
PIECE = 1 << 19        # bytes of text entered at a time
SLICE = 1 << 19        # entries merged at a time
SLOT_BITS = 22         # of the slots in which a partition's occurrences are added up, at most
SALTS = 16
LOAD_BYTES = 32 << 20  # text bytes a prefix partition stands for, at most
MASK = (1 << 31) - 1

RUN = "part int, run binary"
COUNTED = "lang string, k int, phrase string, f bigint"

# Upper-case letters become lower-case ones, a tab a blank, what ends a piece a full stop.
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t,;:!?\n\x0b\x0c\r",
                         b"abcdefghijklmnopqrstuvwxyz .........")


class Trie:
    """Counts of word triples: a path of one or two words, hash containers below.

    Words are numbers from 1 on; 0 stands for the end of a piece.
    """

    def __init__(self):
        self.boxes: dict[int, dict[int, int]] = {}     # path -> rest -> count
        self.burst: set[int] = set()                   # first words whose container has burst
        self.entries = 0

    def add(self, first: np.ndarray, second: np.ndarray, third: np.ndarray) -> None:
        deep = np.isin(first, np.fromiter(self.burst, dtype=np.int64, count=len(self.burst)))
        path = np.where(deep, first << 31 | second, first)
        rest = np.where(deep, third, second << 31 | third)
        boxes, new, touched = self.boxes, 0, set()
        find = boxes.get
        for p, r in zip(path.tolist(), rest.tolist()):
            if (box := find(p)) is None:
                boxes[p] = {r: 1}
                new += 1
            elif r in box:
                box[r] += 1
            else:
                box[r] = 1
                new += 1
                if len(box) > BURST:
                    touched.add(p)
        self.entries += new
        for p in touched:
            if p <= MASK:
                self._burst(p)

    def _burst(self, first: int) -> None:
        for rest, count in self.boxes.pop(first).items():
            self.boxes.setdefault(first << 31 | rest >> 31, {})[rest & MASK] = count
        self.burst.add(first)

    def take(self, leave: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Remove the largest whole subtrees until ``leave`` entries are left: (first, second, third, count)."""
        paths = np.fromiter(self.boxes, dtype=np.int64, count=len(self.boxes))
        sizes = np.fromiter(map(len, self.boxes.values()), dtype=np.int64, count=len(paths))
        roots, own = np.unique(np.where(paths > MASK, paths >> 31, paths), return_inverse=True)
        held = np.bincount(own, sizes, len(roots)).astype(np.int64)
        order = np.argsort(-held, kind="stable")
        left = self.entries - np.cumsum(held[order])   # once a subtree is gone
        gone = np.zeros(len(roots), dtype=bool)
        gone[order[left + held[order] > leave]] = True
        chosen = gone[own]
        boxes = list(map(self.boxes.pop, paths[chosen].tolist()))
        self.burst -= set(roots[gone].tolist())
        path = np.repeat(paths[chosen], sizes[chosen])
        self.entries -= len(path)
        rest = np.fromiter(chain.from_iterable(boxes), dtype=np.int64, count=len(path))
        count = np.fromiter(chain.from_iterable(map(dict.values, boxes)), dtype=np.int64, count=len(path))
        deep = path > MASK
        return (np.where(deep, path >> 31, path), np.where(deep, path & MASK, rest >> 31), rest & MASK, count)


class Words(dict):
    """Numbers of the words of all languages, in order of appearance; ``.`` ends a piece."""

    def __init__(self, lang: str, texts: list[tuple[str, bytes]]):
        super().__init__({b".": 0})
        self.lang, self.texts = lang, texts

    def __missing__(self, word: bytes) -> int:
        self.texts.append((self.lang, word))
        self[word] = number = len(self.texts) - 1
        return number


def _pieces(text: bytes):
    """Token lists of a text, a bounded stretch at a time, cut where a piece ends."""
    at = 0
    text = text.translate(_TABLE)
    while at < len(text):
        cut = text.find(b".", at + PIECE)
        end = len(text) if cut < 0 else cut + 1
        yield text[at:end].replace(b".", b" . ").split()
        at = end


class Counter:
    """The trie, dictionary and spilling of one task."""

    def __init__(self, parts: int):
        self.parts = parts
        self.totals: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.trie = Trie()
        self.texts: list[tuple[str, bytes]] = [("", b".")]
        self.langs: dict[str, Words] = {}

    def enter(self, lang: str, text: bytes):
        """Count a text of one language; yields runs when a bound is passed."""
        for tokens in _pieces(text):
            words = self.langs.get(lang)
            if words is None:
                words = self.langs[lang] = Words(lang, self.texts)
            ids = np.fromiter(map(words.__getitem__, tokens), dtype=np.int64, count=len(tokens))
            ids = np.concatenate([ids, [0, 0]])
            second = np.where(ids[:-2] > 0, ids[1:-1], 0)
            third = np.where(second > 0, ids[2:], 0)
            held = ids[:-2] > 0
            self.totals[lang] = self.totals.get(lang, 0) + int(held.sum())
            self.trie.add(ids[:-2][held], second[held], third[held])
            if len(self.texts) > WORDS:
                yield from self.spill(0)
                self._clear()                         # numbers stay below 2**BITS
            elif self.trie.entries > ENTRIES:
                yield from self.spill(ENTRIES // 2)
            else:
                continue
            trim_memory()                             # what a spill took is not kept

    def finish(self):
        """The rest of the trie and the word totals."""
        yield from self.spill(0)
        if self.totals:
            run = _pack(0, [], np.array(list(self.totals.values())), 
                        Texts([(lang, b"") for lang in self.totals]))
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([run], pa.binary())],
                                             names=["part", "run"])

    def spill(self, leave: int):
        first, second, third, count = self.trie.take(leave)
        if not len(first):
            return
        # Numbers become ranks in the order of (lang, word), so that runs are sorted by text.
        held = np.zeros(len(self.texts), dtype=bool)
        for numbers in (first, second, third):
            held[numbers] = True
        held[0] = False
        used = np.flatnonzero(held)
        own = [self.texts[i] for i in used.tolist()]
        number = {lang: i.to_bytes(4, "big") for i, lang in enumerate(sorted({lang for lang, _ in own}))}
        keys = [number[lang] + word for lang, word in own]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        texts = [("", b""), *[own[i] for i in order]]
        rank = np.zeros(len(self.texts), dtype=np.int64)
        rank[used[order]] = np.arange(1, len(texts))
        packed = Texts(texts)
        mixed = packed.hashes()
        key = rank[first] << 2 * BITS | rank[second] << BITS | rank[third]
        order = np.argsort(key)
        key, count = key[order], count[order]
        for k in (1, 2, 3):
            own = key >> (3 - k) * BITS
            whole = (own & LAST) > 0                  # none of the k words is the end of a piece
            if not whole.any():
                continue
            own, n = own[whole], count[whole]
            starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            own, sums = own[starts], np.add.reduceat(n, starts)
            columns = [own >> (k - 1 - i) * BITS & LAST for i in range(k)]
            prefix = mixed[columns[0]]
            if k > 1:
                prefix = prefix * np.uint64(0x9E3779B97F4A7C15) + mixed[columns[1]]
            if k > 2:
                prefix += mixed[columns[2]] % np.uint64(SALTS)
            part = (_spread(prefix) % np.uint64(self.parts)).astype(np.int64)
            yield from _runs(k, part, columns, sums, packed)


def _spread(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def _runs(k: int, part: np.ndarray, columns: list[np.ndarray], sums: np.ndarray, texts: Texts):
    """One sorted run for every partition that has phrases."""
    order = np.argsort(part, kind="stable")          # keeps the phrases sorted within a partition
    part, sums = part[order], sums[order]
    columns = [x[order] for x in columns]
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    ends = np.append(starts[1:], len(part))
    for at in range(0, len(starts), 64):
        cuts = list(zip(starts[at:at + 64].tolist(), ends[at:at + 64].tolist()))
        bodies = [_pack(k, [x[s:e] for x in columns], sums[s:e], texts) for s, e in cuts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[starts[at:at + 64]], pa.int32()), pa.array(bodies, pa.binary())], names=["part", "run"])


def _narrow(values: np.ndarray) -> tuple[int, bytes]:
    """Width in bytes and little-endian bytes of unsigned numbers."""
    most = int(values.max()) if len(values) else 0
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
    return width, values.astype(f"<u{width}").tobytes()


class Texts:
    """Langs and words of a spill, by rank."""

    def __init__(self, texts: list[tuple[str, bytes]]):
        self.names = list(dict.fromkeys(lang for lang, _ in texts))
        number = {lang: i for i, lang in enumerate(self.names)}
        self.lang = np.array([number[lang] for lang, _ in texts], dtype=np.int64)
        self.words = pa.array([word for _, word in texts], pa.large_binary())

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the words, which agree between tasks; 0 for the empty one at rank 0."""
        offsets = np.frombuffer(self.words.buffers()[1], dtype=np.int64, count=len(self.words) + 1)
        data = np.frombuffer(self.words.buffers()[2], dtype=np.uint8, count=int(offsets[-1]))
        return np.concatenate((np.zeros(1, dtype=np.uint64), joined_hashes(data, np.diff(offsets)[1:])))

    def of(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
        """Lang numbers, sizes and joined bytes of some words."""
        words = pc.take(self.words, pa.array(ranks))
        offsets = np.frombuffer(words.buffers()[1], dtype=np.int64, count=len(words) + 1)
        data = words.buffers()[2]
        return self.lang[ranks], np.diff(offsets), data.to_pybytes()[:offsets[-1]] if data else b""


def _pack(k: int, columns: list[np.ndarray], sums: np.ndarray, texts: Texts) -> bytes:
    """Phrase length, then compressed: a header, the run's own words, each phrase by their numbers, the counts."""
    import zstandard

    used, codes = np.unique(np.concatenate(columns), return_inverse=True) if k else (np.arange(len(sums)), None)
    langs, sizes, words = texts.of(used)
    # The first words are sorted: their steps are small.
    codes = [np.diff(c, prepend=0) if i == 0 else c for i, c in enumerate(np.split(codes, k))] if k else []
    packed = [_narrow(x) for x in (langs, sizes, *codes, sums)]
    header = json.dumps([len(used), len(sums), len(words), texts.names, [w for w, _ in packed]]).encode()
    body = b"".join([len(header).to_bytes(4, "little"), header, words, *[b for _, b in packed]])
    return bytes([k]) + zstandard.compress(body, 1)


class Run:
    """A run as unpacked: its own words, the phrases by their numbers, the counts."""

    def __init__(self, run: bytes):
        import zstandard

        self.k, body = run[0], zstandard.decompress(run[1:])
        at = 4 + int.from_bytes(body[:4], "little")
        n_words, n, size, self.names, widths = json.loads(body[4:at])
        self.words = np.frombuffer(body, dtype=np.uint8, count=size, offset=at)
        at += size
        arrays = []
        for i, width in enumerate(widths):
            count = n if i > 1 else n_words
            arrays.append(np.frombuffer(body, dtype=f"<u{width}", count=count, offset=at))
            at += count * width
        self.lang_of, self.sizes, *self.codes, self.f = arrays
        if self.k:
            # Steps are unsigned, and their sums numbers of words.
            self.codes[0] = np.cumsum(self.codes[0], dtype=np.int64).astype(np.int32)

    def hashes(self) -> np.ndarray:
        """Hash of each phrase and its lang, the same in every run."""
        words = joined_hashes(self.words, self.sizes.astype(np.int64))
        # A lang, which may be empty, as the end of a word of its own.
        names = [b"\0" + name.encode() for name in self.names]
        langs = joined_hashes(np.frombuffer(b"".join(names), dtype=np.uint8), np.array([len(n) for n in names]))
        total = langs[self.lang_of[self.codes[0]]]
        for own in self.codes:
            total = _spread(total * np.uint64(0x9E3779B97F4A7C15) + words[own])
        return total

    def table(self, chosen: np.ndarray | None = None) -> pa.Table:
        """(lang, phrase, f) of the phrases, or of the chosen places, in the run's order."""
        codes, f = self.codes, self.f
        if chosen is not None:
            codes, f = [c[chosen] for c in codes], f[chosen]
        if self.k == 0:
            phrase, first = pa.array([b""] * len(f), pa.large_binary()), np.arange(len(f))
        else:
            offsets = pa.array(np.concatenate(([0], np.cumsum(self.sizes, dtype=np.int64))))
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.sizes),
                                                     [None, offsets.buffers()[1], pa.py_buffer(self.words)])
            texts = [pc.take(words, pa.array(c)) for c in codes]
            phrase = texts[0]
            if self.k > 1:
                phrase = pc.binary_join_element_wise(*texts, pa.scalar(b" ", pa.large_binary()))
            first = codes[0]
        lang = pc.take(pa.array(self.names, pa.string()), pa.array(self.lang_of[first].astype(np.int64)))
        return pa.table({"lang": lang, "phrase": phrase, "f": f.astype(np.int64)})


def _often(runs: list[Run]) -> list[pa.Table]:
    """The phrases of some runs of one length, but for those that certainly occur less than ``LEAST`` times.

    Occurrences are added up by slots of the phrases' hashes.  A slot's sum is
    at least the count of each of its phrases, so none that is frequent
    enough goes; the few others that share a slot with it are dropped by
    their exact sums.
    """
    total = sum(len(r.f) for r in runs)
    size = 1 << min(SLOT_BITS, max(10, (4 * total).bit_length()))
    sums = np.zeros(size, dtype=np.int64)
    slots = []
    for run in runs:
        slots.append((run.hashes() & np.uint64(size - 1)).astype(np.uint32))
        np.add.at(sums, slots[-1], run.f.astype(np.int64))
    return [run.table(np.flatnonzero(sums[own] >= LEAST)) for run, own in zip(runs, slots)]


def merge_runs(frame: pd.DataFrame) -> pd.DataFrame:
    """(lang, k, phrase, f) of the phrases of one partition with enough occurrences.

    Phrases that are too rare by the sums of their hashes' slots go first.  What
    is left of the runs of one phrase length is cut at common phrases into slices of
    about ``SLICE`` entries, which are merged one after the other.
    """
    found = []
    by_k: dict[int, list[bytes]] = {}
    for run in frame["run"]:
        by_k.setdefault(run[0], []).append(run)
    for k, packed in sorted(by_k.items()):
        runs = [Run(r) for r in packed]
        for table in _slices(_often(runs) if k else [r.table() for r in runs]):
            sums = table.group_by(["lang", "phrase"]).aggregate([("f", "sum")])
            if k:
                sums = sums.filter(pc.greater_equal(sums["f_sum"], LEAST))
            found.append(pd.DataFrame({"lang": sums["lang"].to_pandas(), "k": k,
                                       "phrase": [p.decode() for p in sums["phrase"].to_pylist()],
                                       "f": sums["f_sum"].to_pandas()}))
    if not found:
        return pd.DataFrame({"lang": [], "k": [], "phrase": [], "f": []})
    return pd.concat(found, ignore_index=True)


def _slices(runs: list[pa.Table]):
    """Tables that hold every run's entries of one range of (lang, phrase)."""
    runs = [r for r in runs if len(r)]
    total = sum(len(r) for r in runs)
    if total <= SLICE:
        if runs:
            yield pa.concat_tables(runs)
        return
    step = max(1, total // (len(runs) * 16))
    sample = sorted({_key(r, i) for r in runs for i in range(0, len(r), step)})
    every = max(1, len(sample) * SLICE // total)
    bounds = sample[every::every]
    at = [0] * len(runs)
    for bound in [*bounds, None]:
        ends = [len(r) if bound is None else _first_at_least(r, bound, a) for r, a in zip(runs, at)]
        pieces = [r.slice(a, e - a) for r, a, e in zip(runs, at, ends) if e > a]
        if pieces:
            yield pa.concat_tables(pieces)
        at = ends


def _key(run: pa.Table, i: int) -> tuple:
    """Lang and words of an entry, in whose order runs are sorted."""
    return run["lang"][i].as_py(), tuple(run["phrase"][i].as_py().split(b" "))


def _first_at_least(run: pa.Table, bound: tuple, low: int) -> int:
    high = len(run)
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if _key(run, middle) < bound else (low, middle)
    return low


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, k, phrase, f): phrases of 1 to 3 words with at least ``LEAST`` occurrences, and k = 0: all words."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       text_or_empty(text_col).cast("binary").alias("text"))
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-volume // LOAD_BYTES))

    def count(batches):
        counter = Counter(parts)
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in dict.fromkeys(langs):
                yield from counter.enter(lang, b".".join([t for x, t in zip(langs, texts) if x == lang]))
        yield from counter.finish()

    runs = rows.mapInArrow(trimmed(count), RUN)
    counted = runs.groupBy("part").applyInPandas(merge_runs, COUNTED)
    return stage(counted, "phrase-counts")


def floor_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) of counts below 10**16, exactly."""
    wide = lambda c: c.cast("decimal(16,0)")
    top = (wide(a) * wide(a)).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), (wide(left) * wide(right)).cast("decimal(38,0)"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best collocations."""
    counts = phrase_counts(docs, text_col, lang_col)
    totals = counts.filter("k = 0").select("lang", F.col("f").alias("n"))
    words = F.split("phrase", " ")
    part = lambda start, size: F.array_join(F.slice(words, start, size), " ")
    candidates = counts.filter("k >= 2")
    cuts = candidates.select(
        "lang", "phrase", "k", F.col("f").alias("a"),
        F.explode(F.transform(F.sequence(F.lit(1), F.col("k") - 1), lambda i: F.struct(
            i.alias("cut"), part(F.lit(1), i).alias("head"),
            part(i + 1, F.col("k") - i).alias("tail")))).alias("c")).select("lang", "phrase", "k", "a", "c.*")
    known = lambda key, f: counts.select(F.col("lang").alias(f"{key}_lang"), F.col("phrase").alias(f"{key}_text"),
                                         F.col("f").alias(f))
    for key, f in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(known(key, f), (F.col("lang") == F.col(f"{key}_lang")) & (F.col(key) == F.col(f"{key}_text")))
    cuts = cuts.withColumn("score", floor_score(F.col("a"), F.col("l"), F.col("r")))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r", "a")).alias("b"))
    longer = candidates.filter("k > 2").select(
        F.col("lang").alias("inner_lang"), F.col("f"),
        F.explode(F.array_distinct(F.array(part(1, 2), part(2, 2)))).alias("inner")).groupBy(
        "inner_lang", "inner").agg(F.max("f").alias("within"))
    kept = best.join(longer, (F.col("lang") == F.col("inner_lang")) & (F.col("phrase") == F.col("inner")), "left").filter(
        F.col("within").isNull() | (F.col("within") * 100 < F.col("b.a") * HALF))
    order = Window.partitionBy("lang").orderBy(F.desc("b.score"), F.desc("b.a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "b.a", "b.l", "b.r", "n", "b.score")
