"""Phrase collocations counted in quotient filters.

Texts are cut into pieces and words, and each task turns them into shards: the distinct words of up
to ``SHARD`` tokens of one language with their counts, a row each, and the tokens as numbers of these
words, ``CHUNK`` to a row. Words are counted over all shards; those with at least ``least`` occurrences
get an id, as no other word can be part of a candidate. The ids meet the tokens by shard, and each shard counts
its pairs and triples of such words in counting quotient filters (``quotient.py``), one for each range
of permuted keys. The filters of a range are merged across shards in the order of their keys.
Only phrases that reach ``least`` leave the merge; scores and ranks are joins and windows on them.

A task holds a few shards at most, and no row or batch grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import quotient
from .common import discard, materialize

#: Tokens, and bytes of words, of a shard at about most (some texts more), and of all shards that a task has open, whatever the languages.
SHARD = 1 << 20
SHARD_BYTES = 1 << 24
OPEN = 1 << 21
OPEN_BYTES = 1 << 25
#: Tokens of a row: readers and writers of Parquet hold many rows at once.
CHUNK = 1 << 12
#: Rows and bytes of an Arrow batch, about.
BATCH = 1 << 13
BATCH_BYTES = 1 << 22
#: Tokens of a range of keys at most; ranges are at most 2**RANGES, so that a shard's filters don't get tiny.
RANGE = 1 << 20
RANGES = 14
#: Bits of a word id, at least; from 22 bits on three ids take more than one 64-bit number.
ID_BITS = 16
WIDE_BITS = 32

_WORD, _BLANK, _STOP = range(3)
_KIND = np.full(256, _WORD, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = _STOP
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_TOGETHER = 1 << 20

_CODED = "shard long, lang string, at int, word string, c long, codes binary"
_FILTERS = pa.schema([("n", pa.int32()), ("prefix", pa.int32()), ("filter", pa.binary())])


def words_of(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The words of all texts in order (binary), and which of them begin a piece; some texts at a time.

    A piece ends at every stop and at the end of its text. Null texts have no words.
    """
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if texts.buffers()[2] is None else np.frombuffer(texts.buffers()[2], np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + _TOGETHER, "right")) - 1)
        cut = offsets[first : last + 1] - offsets[first]
        own = _LOWER[data[offsets[first] : offsets[last]]]
        kind = _KIND[own]
        inside = kind == _WORD
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edge = cut[:-1][cut[:-1] < len(own)]
        begins[edge] = inside[edge]  # a text begins anew
        start = np.flatnonzero(begins)
        word = np.cumsum(begins, dtype=np.int32)
        size = np.bincount(word[inside] - 1, minlength=len(start))
        stops = np.cumsum(kind == _STOP, dtype=np.int32)[start]
        text = np.searchsorted(cut, start, "right")
        fresh = np.ones(len(start), bool)
        fresh[1:] = (stops[1:] != stops[:-1]) | (text[1:] != text[:-1])
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        yield pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(own[inside])]), fresh
        first = last


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Tasks that start in here get Arrow batches of about ``BATCH_BYTES``, on both sides of the pipe."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of words (at, word, c) and rows of tokens (at, codes), by shard; a code is inverted where a piece begins."""
    open_: dict[str, list] = {}
    task, made, tokens, size = TaskContext.get().partitionId(), 0, 0, 0

    def rows(lang: str, at: np.ndarray, word: pa.Array, c: pa.Array, codes: pa.Array) -> pa.RecordBatch:
        shard = pa.array(np.full(len(at), task << 32 | made))
        return pa.RecordBatch.from_arrays([shard, pa.repeat(pa.scalar(lang, pa.string()), len(at)), pa.array(at, pa.int32()), word, c, codes], ["shard", "lang", "at", "word", "c", "codes"])

    def close(lang: str) -> Iterator[pa.RecordBatch]:
        nonlocal made, tokens, size
        n, taken, held = open_.pop(lang)
        made, tokens, size = made + 1, tokens - n, size - taken
        fresh = np.concatenate([f for _, f in held])
        coded = pa.concat_arrays([w for w, _ in held]).dictionary_encode()
        held.clear()
        words, codes = coded.dictionary.view(pa.string()), coded.indices.to_numpy().astype(np.int32)
        counts = np.bincount(codes, minlength=len(words))
        for a in range(0, len(words), BATCH):
            own = words.slice(a, BATCH)
            yield rows(lang, np.arange(a, a + len(own)), own, pa.array(counts[a : a + BATCH], pa.int64()), pa.nulls(len(own), pa.binary()))
        codes = np.where(fresh, ~codes, codes)
        cuts = np.append(np.arange(0, n, CHUNK), n)
        step = max(1, BATCH_BYTES // (4 * CHUNK))
        for a in range(0, len(cuts) - 1, step):
            own = cuts[a : a + step + 1]
            data = pa.Array.from_buffers(pa.binary(), len(own) - 1, [None, pa.py_buffer(((own - own[0]) * 4).astype(np.int32)), pa.py_buffer(codes[own[0] : own[-1]])])
            yield rows(lang, np.arange(a, a + len(data)), pa.nulls(len(data), pa.string()), pa.nulls(len(data), pa.int64()), data)

    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        which = langs.indices.to_numpy()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            own = batch.column(1) if len(langs.dictionary) == 1 else batch.column(1).take(pa.array(np.flatnonzero(which == k)))
            for words, fresh in words_of(own):
                if not len(words):
                    continue
                have = open_.setdefault(lang, [0, 0, []])
                have[0] += len(words)
                have[1] += int(words.buffers()[2].size)
                have[2].append((words, fresh))
                tokens, size = tokens + len(words), size + int(words.buffers()[2].size)
                if have[0] >= SHARD or have[1] >= SHARD_BYTES:
                    yield from close(lang)
                elif tokens >= OPEN or size >= OPEN_BYTES:
                    yield from close(max(open_, key=lambda x: open_[x][0 if tokens >= OPEN else 1]))
    for lang in list(open_):
        yield from close(lang)


def width_of(n: int, bits: int) -> int:
    """The width of keys of n ids."""
    return bits * n if bits * n <= 64 else 3 * WIDE_BITS


def packed(ids: list[np.ndarray], bits: int) -> quotient.Keys:
    """Two or three columns of ids as keys."""
    if bits * len(ids) <= 64:
        x = ids[0].astype(np.uint64)
        for y in ids[1:]:
            x <<= np.uint64(bits)
            x |= y
        return [x]
    return [*packed(ids[:2], WIDE_BITS), ids[2].astype(np.uint64)]


def unpacked(keys: quotient.Keys, n: int, bits: int) -> list[np.ndarray]:
    if len(keys) == 1:
        mask = np.uint64(2**bits - 1)
        return [(keys[0] >> np.uint64(bits * (n - 1 - k)) & mask).astype(np.int64) for k in range(n)]
    return [(keys[0] >> np.uint64(WIDE_BITS)).astype(np.int64), (keys[0] & np.uint64(2**WIDE_BITS - 1)).astype(np.int64), keys[1].astype(np.int64)]


def shard_filters(codes: np.ndarray, at: np.ndarray, ids: np.ndarray, bits: int, prefix_bits: int) -> Iterator[tuple[int, int, bytes]]:
    """n, prefix, filter of the pairs and triples of a shard, in which the codes ``at`` have ``ids`` and others none."""
    fresh = codes < 0
    codes = codes ^ (codes >> 31)
    known, has = np.zeros(int(codes.max(initial=0)) + 1, np.uint32), np.zeros(int(codes.max(initial=0)) + 1, bool)
    known[at], has[at] = ids, True
    word, has = known[codes], has[codes]
    here = has[:-1] & has[1:] & ~fresh[1:]
    del codes, fresh, has
    for n in (2, 3):
        if n == 3:
            here = here[:-1] & here[1:]
        for prefix, data in quotient.filters(packed([word[k : k + len(here)][here] for k in range(n)], bits), None, width_of(n, bits), prefix_bits):
            yield n, prefix, data


def phrase_counts(coded: DataFrame, ids: DataFrame, least: int, bits: int, prefix_bits: int) -> DataFrame:
    """n, w1, w2, w3 (-1 for none), f of all phrases of 2 and 3 words that have ids and occur ``least`` times or more.

    ``coded`` holds the shards' tokens (shard, at, codes), ``ids`` (shard, at, id) the ids of their words. A word's id implies its language.
    """
    tasks = int(coded.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(tokens: pa.Table, known: pa.Table) -> pa.Table:
        if not tokens.num_rows or not known.num_rows:
            return _FILTERS.empty_table()
        codes = np.concatenate([np.frombuffer(x.as_buffer(), np.int32) for part in tokens.sort_by("at").column("codes").chunks for x in part])
        out, part, size = [], [], 0

        def close() -> None:
            out.append(pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*part, strict=True), _FILTERS.types, strict=True)], schema=_FILTERS))
            part.clear()

        for x in shard_filters(codes, known.column("code").to_numpy(), known.column("id").to_numpy(), bits, prefix_bits):
            part.append(x)
            size += len(x[2])
            if len(part) >= BATCH or size >= BATCH_BYTES:
                close()
                size = 0
        if part:
            close()
        return pa.Table.from_batches(out, _FILTERS)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by (n, prefix); filters are merged as they come, so that only one range is held."""
        now, parts, held, waiting = None, [], 0, 0

        def close() -> Iterator[pa.RecordBatch]:
            if now is None:
                return
            n, width = now[0], width_of(now[0], bits)
            keys, counts = quotient.merge(parts)
            own = counts >= least
            found = unpacked(quotient.restore([k[own] for k in keys], width), n, bits)
            found += [np.full(own.sum(), -1)] * (3 - n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(own.sum(), n, np.int32)), *map(pa.array, found), pa.array(counts[own])], ["n", "w1", "w2", "w3", "f"])

        for batch in batches:
            for n, prefix, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if now != (n, prefix):
                    yield from close()
                    now, parts, held, waiting = (n, prefix), [], 0, 0
                parts.append(quotient.decode(data.as_buffer(), width_of(n, bits), prefix_bits, prefix))
                waiting += len(parts[-1][1])
                if waiting > max(held, RANGE):
                    parts = [quotient.merge(parts)]
                    held, waiting = len(parts[0][1]), 0
        yield from close()

    named = ids.select(F.col("shard").alias("of"), F.col("at").alias("code"), "id")  # both sides come from one table, so columns need names of their own
    counted = coded.groupBy("shard").cogroup(named.groupBy("of")).applyInArrow(count, "n int, prefix int, filter binary")
    filters = counted.repartition(tasks, "n", "prefix").sortWithinPartitions("n", "prefix")
    return filters.mapInArrow(merged, "n int, w1 long, w2 long, w3 long, f long")


def ranked(found: DataFrame, ids: DataFrame, total: DataFrame, share: int, top: int) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the phrases that ``phrase_counts`` found; ``ids`` has lang, word, f and id, ``total`` lang and n.

    Each language is ranked by shares first, which leave at most ``top`` phrases each, so that no task gets all of a language or all ties.
    """
    one = lambda k: ids.select(F.col("id").alias(f"w{k}"), F.col("f").alias(f"f{k}"))
    pairs = found.where("n = 2").select("w1", "w2", F.col("f").alias("a"))
    triples = found.where("n = 3").select("w1", "w2", "w3", F.col("f").alias("a"))
    # Counts below 10**14 in 14 digits: every product fits 38 digits, so the division is exact.
    score = lambda left, right: F.expr(f"cast(1000000 as decimal(7,0)) * cast(a as decimal(14,0)) * cast(a as decimal(14,0)) div (cast({left} as decimal(14,0)) * cast({right} as decimal(14,0)))")
    around = triples.select("w1", "w2", "a").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")).groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    two = pairs.join(around, ["w1", "w2"], "left").where(F.coalesce(100 * F.col("longer") < share * F.col("a"), F.lit(True)))
    two = two.join(one(1), "w1").join(one(2), "w2").select("w1", "w2", F.lit(-1).cast("long").alias("w3"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), score("f1", "f2").alias("score"))
    head = pairs.select("w1", "w2", F.col("a").alias("f12"))
    tail = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"))
    three = triples.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"]).join(one(1), "w1").join(one(3), "w3")
    three = three.withColumns({"early": score("f1", "f23"), "late": score("f12", "f3")})
    cut = F.col("early") <= F.col("late")
    three = three.select("w1", "w2", "w3", "a", F.when(cut, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(cut, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("early", "late").alias("score"))

    spell = lambda k: ids.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"s{k}"))
    langs = ids.select(F.col("id").alias("w1"), "lang")
    # About as many shares as make them as large as what they leave.
    shares = 1 << (found.count() // max(1, top)).bit_length() // 2
    order = [F.desc("score"), F.desc("a")]
    best = two.unionByName(three).join(langs, "w1").withColumn("deal", F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(shares)))
    # Ties that reach past the last place stay until their phrases are spelt.
    best = best.withColumn("place", F.rank().over(Window.partitionBy("lang", "deal").orderBy(*order))).where(F.col("place") <= top)
    spelt = best.join(spell(1), "w1").join(spell(2), "w2").join(spell(3), "w3", "left").withColumn("phrase", F.concat_ws(" ", "s1", "s2", "s3"))
    for group in (["lang", "deal"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order, "phrase"))
        spelt = spelt.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return spelt.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of two or three words of each language.

    ``docs`` has lang and text; other columns are ignored. A null lang counts as ``und``, a null text as empty; every row
    counts, repeated ones too. A-Z are lower-cased. a, l and r are occurrences of the phrase, of its
    first part and of the rest, within pieces, at the cut of least score (then after fewest words), which is
    floor(1000000 * a * a / (l * r)); n are all words of the language. Candidates occur ``least`` times or more;
    one inside a longer candidate that has ``share`` per cent of its occurrences or more is dropped. Order: score, a
    (highest first), phrase by bytes. No candidates give no rows. Counts must stay below 10**14.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    with _small_batches(docs.sparkSession):
        coded = materialize(texts.mapInArrow(_shards, _CODED), "phrases-coded")
    held = coded.where("c is not null").select("shard", "lang", "at", "word", "c")
    counted = held.groupBy("lang", "word").agg(F.sum("c").alias("f")).where(F.col("f") >= least)
    known = materialize(counted, "phrases-words")
    total = held.groupBy("lang").agg(F.sum("c").alias("n"))
    words, tokens = known.count(), held.select(F.sum("c")).first()[0] or 0
    # Numbers without gaps but for a bit: a hash deals the words out, and each deal is numbered by itself.
    deals = 1 << max(0, (words >> 12).bit_length())
    deal = F.pmod(F.xxhash64("lang", "word"), F.lit(deals))
    numbered = known.withColumn("deal", deal).withColumn("id", (F.row_number().over(Window.partitionBy("deal").orderBy("lang", "word")).cast("long") - 1) * deals + F.col("deal")).drop("deal")
    ids = materialize(numbered, "phrases-ids")
    bits = max(ID_BITS, int(ids.agg(F.max("id")).first()[0] or 0).bit_length())
    if bits > WIDE_BITS:
        raise ValueError(f"word ids take {bits} bits, more than {WIDE_BITS}")
    bits = bits if 3 * bits <= 64 else WIDE_BITS
    prefix_bits = min(RANGES, (tokens // RANGE).bit_length())
    of_shards = held.join(ids.select("lang", "word", "id"), ["lang", "word"]).select("shard", "at", "id")
    with _small_batches(docs.sparkSession):
        found = materialize(phrase_counts(coded.where("c is null").select("shard", "at", "codes"), of_shards, least, bits, prefix_bits), "phrases-counted")
    out = materialize(ranked(found, ids, total, share, top), "phrases-ranked")
    discard(coded, known, ids, found)
    return out
