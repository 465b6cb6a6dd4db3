"""Phrases whose words stand together more often than apart (operator 13)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywise.llm import tables, words
from tallywise.operators.skew import MAX_HOT, fits_broadcast
from tallywise.session import Scratch

DEPTH = 5  # words of a suffix
MEMORY = 1 << 18  # suffixes whose subtrees a task builds together
HELD = 1 << 21  # prefixes that a task that reads texts holds
PART = 1 << 20
FLAGS = 1 << 25  # bits of the tables of frequent words and of frequent pairs
BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?\x0a\x0b\x0c\x0d"]] = True
BETWEEN = BREAK.copy()
BETWEEN[[0x20, 0x09]] = True
COLUMNS = [f"w{i + 1}" for i in range(DEPTH)]
NAMED = [*COLUMNS, "lang", "word", "n"]
SUFFIX = ", ".join(f"{c} long" for c in COLUMNS) + ", lang string, word string, n long"


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """For each slice its rows, bytes, starts and ends of words, text of each word, the words' ids, which the
    language goes into, and whether a word goes on the piece of the one before."""
    for batch in batches:
        for part, data, offsets in words.slices(batch, "text"):
            starts, ends, at = words.word_bounds(data, offsets, BETWEEN)
            if not len(starts):
                continue
            text = np.repeat(np.arange(len(part)), np.diff(at))
            salt = np.array([xxhash.xxh3_64_intdigest(x.encode()) for x in part["lang"].to_pylist()], np.uint64)
            ids = words.mix(words.word_hashes(data, starts, ends) + salt[text])
            breaks = np.cumsum(BREAK[data], dtype=np.int64)[starts]
            on = np.zeros(len(starts), bool)
            on[1:] = (text[1:] == text[:-1]) & (breaks[1:] == breaks[:-1])
            yield part, data, starts, ends, text, ids, on


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, lang, n): each word's id counted, without ``lang``, and each language's words, without id."""
    for part, _, _, _, text, ids, _ in _ids(batches):
        found, n = np.unique(ids, return_counts=True)
        langs, of = np.unique(np.array(part["lang"].to_pylist(), object)[text], return_inverse=True)
        both = pa.array(np.concatenate([n, np.bincount(of)]))
        id_of = pa.array(np.concatenate([found.view(np.int64), np.zeros(len(langs), np.int64)]))
        yield pa.record_batch([id_of, pa.array([None] * len(found) + langs.tolist(), pa.string()), both], ["id", "lang", "n"])


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flags = np.zeros(FLAGS // 8, np.uint8)
    for batch in batches:
        at = batch["id"].to_numpy().view(np.uint64) % np.uint64(FLAGS)
        np.bitwise_or.at(flags, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
    yield tables.segments(flags)


def _table(ids: DataFrame) -> np.ndarray:
    """The bits of all ``ids`` (id). They are dealt by their part of the table, so that each part is made once."""
    part = F.floor(F.pmod(F.col("id"), F.lit(FLAGS)) / (8 * tables.SEGMENT))
    dealt = ids.select("id", part.alias("part")).repartition("part").select("id")
    return tables.total(dealt.mapInArrow(_flags, tables.SCHEMA), FLAGS // 8, "uint8", np.bitwise_or)


def _marked(ids: np.ndarray, flags: np.ndarray) -> np.ndarray:
    at = ids % np.uint64(FLAGS)
    return (flags[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return words.mix(first * words.BASE + second)


def _merged(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[: len(keys)]
    return keys[heads], np.add.reduceat(n, heads) if len(heads) else n


def _prefixes(flags: np.ndarray, bits: int):
    """The prefixes of two words that may both be frequent, counted: a row for each part, the first ``bits``
    bits of a prefix's key, with the 32 bits after them and the counts as arrays. Packed like this a
    prefix takes some four bytes of a shuffle."""

    def packed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, n = _merged(*(np.concatenate(x) for x in zip(*held, strict=True)))
        part = (keys >> np.uint64(32)).astype(np.int64)
        heads = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))[: len(part)]
        cuts = list(zip(heads.tolist(), [*heads[1:].tolist(), len(part)], strict=True)) if len(part) else []
        low, n = keys.astype(np.uint32), n.astype(np.uint32)
        columns = [pa.array([x[a:b].tobytes() for a, b in cuts], pa.binary()) for x in (low, n)]
        return pa.record_batch([pa.array(part[heads]), *columns], ["part", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for *_, ids, on in _ids(batches):
            known = _marked(ids, flags)
            at = np.flatnonzero(on[1:] & known[1:] & known[:-1])
            held.append(np.unique(_key(_pair(ids[at], ids[at + 1]), bits), return_counts=True))
            if sum(len(n) for _, n in held) >= HELD:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    return run


def _key(pairs: np.ndarray, bits: int) -> np.ndarray:
    return pairs >> np.uint64(32 - bits)


def _often(least: int):
    """Rows of (part, keys, counts) sorted by part → the keys that are counted ``least`` times or more. Those
    of one part are held."""

    def kept(part: int, held: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        keys, n = (np.frombuffer(b"".join(x), np.uint32) for x in zip(*held, strict=True))
        keys, n = _merged(keys, n.astype(np.int64))
        found = keys[n >= least].astype(np.int64) + (part << 32)
        return pa.record_batch([pa.array(found)], ["id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            for part, keys, counts in zip(batch["part"].to_pylist(), batch["keys"], batch["counts"], strict=True):
                if held and part != last:
                    yield kept(last, held)
                    held = []
                last = part
                held.append((keys.as_py(), counts.as_py()))
        if held:
            yield kept(last, held)

    return run


def _suffixes(known: np.ndarray, paired: np.ndarray, bits: int):
    """Each suffix up to DEPTH words, as far as its pairs may be frequent, counted within a slice. Rows with
    ``word`` spell the id in ``w1``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, starts, ends, text, ids, on in _ids(batches):
            link = np.zeros(len(ids) + DEPTH, bool)  # whether the next word goes on
            at = np.flatnonzero(on[1:])
            at = at[_marked(ids[at], known) & _marked(ids[at + 1], known)]
            link[at[_marked(_key(_pair(ids[at], ids[at + 1]), bits), paired)]] = True
            first = np.flatnonzero(link)
            rows = np.zeros((DEPTH, len(first)), np.uint64)
            rows[0] = ids[first]
            alive = np.ones(len(first), bool)
            for i in range(1, DEPTH):
                alive &= link[first + i - 1]
                rows[i, alive] = ids[first[alive] + i]
            key = rows[0]
            for i in range(1, DEPTH):
                key = _pair(key, rows[i])
            _, one, n = np.unique(key, return_index=True, return_counts=True)
            none = pa.nulls(len(one), pa.string())
            yield pa.record_batch([*(pa.array(r[one].view(np.int64)) for r in rows), none, none, pa.array(n)], NAMED)
            # The words that are in them, to be spelt.
            held = np.zeros(len(ids) + DEPTH, bool)
            held[first] = held[first + 1] = True
            at = np.flatnonzero(held[: len(ids)])
            found, one = np.unique(ids[at], return_index=True)
            at, low = at[one], memoryview(words._LOWER[data])
            spelt = pa.array([str(low[a:b], "utf-8") for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)], pa.string())
            zero = pa.array(np.zeros(len(at), np.int64))
            yield pa.record_batch([pa.array(found.view(np.int64)), *[zero] * (DEPTH - 1), part["lang"].take(pa.array(text[at])), spelt, zero], NAMED)

    return run


def _subtrees(budget: int, least: int):
    """Suffixes sorted by their words → the phrases (words, n) of the subtrees' nodes.

    The subtrees of as many prefixes as ``budget`` allows are built at a time. A node's count is the sum
    of its leaves' totals. Nodes below ``least`` go; those above a prefix that was extended are partial.
    """

    def built(rows: np.ndarray, n: np.ndarray, unit: np.ndarray) -> Iterator[pa.RecordBatch]:
        fresh = np.zeros(len(n), bool)
        fresh[:1] = True
        fresh[1:] = rows[0, 1:] != rows[0, :-1]
        for depth in range(2, DEPTH + 1):
            fresh = fresh.copy()
            fresh[1:] |= rows[depth - 1, 1:] != rows[depth - 1, :-1]
            heads = np.flatnonzero(fresh)
            totals = np.add.reduceat(n, heads)
            keep = (rows[depth - 1, heads] != 0) & ((totals >= least) | (depth < unit[heads]))
            found = rows[:depth, heads[keep]].T.copy()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * depth), pa.array(found.ravel()))
            yield pa.record_batch([lists, pa.array(totals[keep])], ["words", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append((np.stack([batch[c].to_numpy() for c in COLUMNS]), batch["n"].to_numpy(), batch["unit"].to_numpy()))
            if sum(len(n) for _, n, _ in held) < budget:
                continue
            rows, n, unit = (np.concatenate(x, axis=-1) for x in zip(*held, strict=True))
            # All whole prefixes up to here; a prefix ends where a word changes within its length.
            changed = np.logical_or.accumulate(rows[:, 1:] != rows[:, :-1], axis=0)
            ends = np.flatnonzero(changed[unit[1:] - 1, np.arange(len(n) - 1)])
            cut = int(ends[-1]) + 1 if len(ends) else 0
            if cut:
                yield from built(rows[:, :cut], n[:cut], unit[:cut])
            held = [(rows[:, cut:], n[cut:], unit[cut:])]
        if held:
            yield from built(*(np.concatenate(x, axis=-1) for x in zip(*held, strict=True)))

    return run


def _partitioned(suffixes: DataFrame, scratch: Scratch, budget: int) -> DataFrame:
    """Vertical partitioning: the suffixes with ``unit``, the length of the shortest prefix that has no more than
    ``budget`` suffixes, or that is whole. Prefixes above the budget are extended by a word at a time. As
    the budget is a ten-thousandth of all suffixes at least, there are fewer than MAX_HOT of them."""
    rows = suffixes.withColumn("unit", F.lit(2))
    over = suffixes.withColumn("hot", F.lit(True))
    for depth in range(2, DEPTH):
        prefix = COLUMNS[:depth]
        # Of the prefixes that were extended before, the longer ones; the rest need no more.
        counted = over.groupBy(*prefix).agg(F.sum("n").alias("total")).filter(F.col("total") > budget)
        large = scratch.write(counted.select(*prefix, F.lit(True).alias("large")), "large")
        if not large.limit(1).count():
            break
        rows = rows.join(F.broadcast(large), prefix, "left")
        rows = rows.withColumn("unit", F.when(F.col("large"), F.lit(depth + 1)).otherwise(F.col("unit"))).drop("large")
        over = over.join(F.broadcast(large.drop("large")), prefix, "left_semi")
    return rows


def frequent_phrases(docs: DataFrame, scratch: Scratch, least: int = 100, memory: int = MEMORY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``phrases`` (words, a): the phrases of 2 to DEPTH words, as arrays of ids, that stand ``least`` times or
    more in ``docs`` (lang, text); ``vocabulary`` (id, lang, word, n) of the words in them and others;
    and ``totals`` (lang, n), the number of all words.

    The texts are read three times: words are counted, then prefixes of two words that are frequent, then
    suffixes are cut where a pair is not, so that a suffix is as deep as a frequent phrase may reach from
    its place. A task that reads texts knows frequent words and pairs by bits of a table of fixed
    size, and what it lets through too much, be it by the table or by a prefix's key of 32 bits and
    more, is counted later like the rest. Suffixes go to a task by their
    prefix, the rows of a prefix within ``memory`` or extended until they are; there the subtrees of
    the prefixes are built in groups of about ``memory`` rows, each group by itself.
    """
    counted = docs.mapInArrow(_counted, "id long, lang string, n long").groupBy("id", "lang").agg(F.sum("n").alias("n"))
    counted = scratch.write(counted.filter((F.col("n") >= least) | F.col("lang").isNotNull()), "counted")
    frequent = counted.filter("lang is null").select("id", "n")
    known = _table(frequent)
    # About PART prefixes share a part, which a task holds.
    spoken = counted.filter("lang is not null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(max((spoken // PART).bit_length(), 6), 31)
    packed = docs.mapInArrow(_prefixes(known, bits), "part long, keys binary, counts binary")
    packed = packed.repartition("part").sortWithinPartitions("part")
    paired = _table(packed.mapInArrow(_often(least), "id long"))

    # Equal suffixes of a task become one before they are shuffled, and then one of all.
    suffixes = docs.mapInArrow(_suffixes(known, paired, bits), SUFFIX).groupBy(*NAMED[:-1]).agg(F.sum("n").alias("n"))
    suffixes = scratch.write(suffixes, "suffixes")
    vocabulary = suffixes.filter("word is not null").select(F.col("w1").alias("id"), "lang", "word").join(frequent, "id")
    suffixes = suffixes.filter("word is null").drop("lang", "word")
    total = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = _partitioned(suffixes, scratch, max(memory, total // MAX_HOT))
    # The prefix that a suffix is dealt by: its words up to ``unit``, others as if there were none.
    key = [F.when(F.col("unit") > i, F.col(c)).otherwise(F.lit(0)) for i, c in enumerate(COLUMNS)]
    rows = rows.repartition(*key).sortWithinPartitions(*COLUMNS)
    nodes = rows.mapInArrow(_subtrees(memory, least), "words array<long>, n long")
    phrases = nodes.groupBy("words").agg(F.sum("n").alias("a")).filter(F.col("a") >= least)
    return scratch.write(phrases, "phrases"), scratch.write(vocabulary, "vocabulary"), counted.filter("lang is not null").select("lang", "n")


def exact_score() -> Column:
    """``floor(1000 a n / (l r))`` of those columns; the products are decimals of 38 digits."""
    a, n, l, r = (F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r"))
    return F.call_function("div", F.lit(1000) * (a * n), l * r)


def collocations(
    docs: DataFrame, scratch: Scratch, least: int = 100, percent: int = 100, top: int = 2000, memory: int = MEMORY,
    lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): of each language the ``top`` phrases of 2 to DEPTH words by score,
    then ``a``, both descending, then phrase by its bytes.

    A-Z are lowered, texts cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words ``[^\\x20\\x09]+``. ``n`` is
    the number of words of the language and ``a`` how often the phrase stands within pieces, overlaps
    included; phrases below ``least`` don't count. Cut after some word, the two parts stand ``l`` and ``r`` times and
    score ``floor(1000 a n / (l r))``, in exact arithmetic; the lowest cut counts, the earliest of ties. A
    phrase that stands within a longer one goes if that one, dropped or not, has ``percent`` % of its count or more.

    A null language is ``und``, a null text empty. Rows that repeat each other count each. Other columns are
    ignored; tables without a frequent phrase give no row. Words are told apart by 64-bit ids.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    phrases, vocabulary, totals = frequent_phrases(rows, scratch, least, memory)
    size = F.size("words")
    counts = phrases.unionByName(vocabulary.select(F.array("id").alias("words"), F.col("n").alias("a")))

    # Both parts of a cut are frequent, as the phrase is.
    k = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    cuts = phrases.select("words", "a", k)
    cuts = cuts.withColumns({"head": F.slice("words", F.lit(1), F.col("k")), "rest": F.slice("words", F.col("k") + 1, size - F.col("k"))})
    cuts = cuts.join(counts.toDF("head", "l"), "head").join(counts.toDF("rest", "r"), "rest")
    words_of = phrases.select("words", F.posexplode("words").alias("place", "id")).join(vocabulary.select("id", "lang", "word"), "id")
    spelt = words_of.groupBy("words").agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("place", "word"))).alias("spelt"))
    spelt = spelt.select("words", "lang", F.array_join("spelt.word", " ").alias("phrase"))
    spelt = spelt.join(F.broadcast(totals) if fits_broadcast(totals) else totals, "lang")

    cuts = cuts.join(spelt, "words").withColumn("score", exact_score())
    scored = cuts.groupBy("words", "lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.slice("words", i, m))))
    longer = phrases.filter(size > 2).select(F.explode(inner).alias("words"), F.col("a").alias("b"))
    longer = longer.groupBy("words").agg(F.max("b").alias("b"))
    kept = scored.join(longer, "words", "left").filter(F.coalesce(100 * F.col("b") < percent * F.col("a"), F.lit(True)))

    # The first ones of each bucket of a language, then those of the language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = kept.withColumn("bucket", F.pmod(F.xxhash64("phrase"), F.lit(buckets)))
    for by in (["lang", "bucket"], ["lang"]):
        kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= top)
    return kept.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
