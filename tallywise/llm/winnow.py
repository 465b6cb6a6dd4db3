"""Document fingerprints by winnowing (operator 3), with built-in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, WINDOW = 5, 8
BASE, PRIME = 1_000_003, 2_147_483_647  # of the polynomial hash
PLACE_BITS = 31  # a text has fewer than 2^31 words


def _joined(df: DataFrame, name: str, other: str, step: int, join) -> DataFrame:
    """Column ``name`` of arrays joined element by element with column ``other``, ``step`` places on.
    Each step is a column of its own, so that the one before is worked out once."""
    count = F.greatest(F.least(F.size(name), F.size(other) - step), F.lit(0))
    pairs = F.zip_with(F.slice(name, F.lit(1), count), F.slice(other, F.lit(1 + step), count), join)
    return df.withColumn("_joined", pairs).drop(name).withColumnRenamed("_joined", name)


def with_gram_hashes(df: DataFrame, words: str, to: str, k: int = K) -> DataFrame:
    """``df`` with the polynomial hash of each run of ``k`` words, modulo a prime. Runs grow by
    doubling: the hash of a + b words is that of the first a times BASE^b, plus that of the next b."""
    df = df.withColumn("_single", F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME)))).withColumn(to, F.col("_single"))
    width = 1
    while width < k:
        step = width if 2 * width <= k else 1
        factor = F.lit(pow(BASE, step, PRIME))
        join = lambda a, b: F.pmod(a * factor + b, F.lit(PRIME))
        df = _joined(df, to, to if step > 1 or width == 1 else "_single", width, join)
        width += step
    return df.drop("_single")


def with_window_minima(df: DataFrame, name: str, window: int = WINDOW) -> DataFrame:
    """Column ``name`` replaced by the minima of its runs of ``window`` elements, by way of minima of
    runs of 1, 2, 4 and so on; the last step overlaps."""
    width = 1
    while width < window:
        step = min(width, window - width)
        df = _joined(df, name, name, step, lambda a, b: F.least(a, b))
        width += step
    return df


def with_fingerprint(df: DataFrame, text: str, to: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """``df`` with the fingerprint of column ``text`` in column ``to``: an array of longs, each the hash of a
    run of ``k`` words (upper bits) and the complement of its place (lower PLACE_BITS bits).

    Words are cut at space, tab and line ends. Of each ``window`` consecutive hashes the smallest is
    kept, of equal ones the rightmost, so that any run of ``window + k - 1`` words that two texts share gives
    a hash that both keep. Packed as one number, smallest and rightmost is a plain minimum. A text
    with fewer hashes than a window keeps the smallest of all, one with fewer than ``k`` words the hash
    of the whole sequence at place 0, one without words, or null, nothing.
    """
    places = (1 << PLACE_BITS) - 1
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    df = with_gram_hashes(df.withColumn("_words", words), "_words", "_grams", k)
    whole = F.when(F.size("_words") > 0, F.array(F.pmod(F.xxhash64(F.array_join("_words", " ")), F.lit(PRIME))))
    whole = whole.otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_grams", F.when(F.size("_words") >= k, F.col("_grams")).otherwise(whole)).drop("_words")
    df = df.withColumn("_packed", F.transform("_grams", lambda h, i: F.shiftleft(h, PLACE_BITS).bitwiseOR(F.lit(places) - i))).drop("_grams")
    df = with_window_minima(df.withColumn("_minima", F.col("_packed")), "_minima", window)
    least = F.when(F.size("_packed") > 0, F.array(F.array_min("_packed"))).otherwise(F.col("_packed"))
    chosen = F.when(F.size("_packed") >= window, F.array_distinct("_minima")).otherwise(least)
    return df.withColumn(to, chosen).drop("_packed", "_minima")


def hashes_of(fingerprint: str) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(fingerprint, lambda x: F.shiftright(x, PLACE_BITS)))


def likeness(left: str, right: str) -> Column:
    """The Jaccard measure of two columns of distinct hashes; 1 if both are empty."""
    both = F.size(F.array_intersect(left, right))
    either = F.size(left) + F.size(right) - both
    return F.when(either == 0, 1.0).otherwise(both / either)


def as_text(fingerprint: str) -> Column:
    """``place:hash`` for each kept hash in order of place, joined by spaces."""
    places = (1 << PLACE_BITS) - 1
    place = lambda x: F.lit(places) - x.bitwiseAND(F.lit(places))
    return F.array_join(F.transform(fingerprint, lambda x: F.concat_ws(":", place(x), F.lower(F.hex(F.shiftright(x, PLACE_BITS))))), " ")


def in_order(docs: DataFrame, buckets: int) -> tuple[DataFrame, Window]:
    """The rows (id, tie, ...) dealt into buckets of neighbouring ids, and the window in which the next
    smaller id follows each. Each bucket has the first row of the next one as an extra row (``own`` is
    false) at its end, the last bucket that of the first, so no task sees all rows.

    Bounds of buckets are approximate quantiles of the ids; only they come to the driver, and one id
    for each bucket is broadcast. Null ids follow all others, in one bucket.
    """
    ids = docs.select(F.col("id").cast("double").alias("v")).dropna()
    bounds = ids.approxQuantile("v", [i / buckets for i in range(1, buckets)], 0.2 / buckets)
    bounds = F.array(*(F.lit(int(b)) for b in sorted(set(bounds)))) if bounds else F.array().cast("array<bigint>")
    rows = docs.withColumn("bucket", F.coalesce(F.size(F.filter(bounds, lambda b: b <= F.col("id"))), F.lit(-1)))
    rows = rows.withColumn("bucket", F.when(F.col("id").isNull(), -1).otherwise(F.col("bucket")))
    heads = rows.groupBy("bucket").agg(F.max(F.struct("id", "tie")).alias("head"))
    down = Window.orderBy(F.desc("bucket"))  # over a row for each bucket
    last = F.min("bucket").over(Window.partitionBy())
    heads = heads.withColumn("before", F.coalesce(F.lag("bucket").over(down), last))
    tagged = rows.join(F.broadcast(heads), "bucket")
    is_head = F.struct("id", "tie").eqNullSafe(F.col("head"))
    own, extra = F.struct("bucket", F.lit(True).alias("own")), F.struct(F.col("before").alias("bucket"), F.lit(False).alias("own"))
    places = F.when(is_head, F.array(own, extra)).otherwise(F.array(own))
    dealt = tagged.select(*docs.columns, F.explode(places).alias("place")).select(*docs.columns, "place.*")
    order = [F.desc("own"), F.col("id").desc_nulls_last(), F.desc("tie")]
    return dealt, Window.partitionBy("bucket").orderBy(*order)


def fingerprint_edits(docs: DataFrame, k: int = K, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row its text's fingerprint, and that of the text with its last third replaced by as
    many characters of the next document's beginning: (``id_col``, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next). The next document is that of the next smaller id,
    after the smallest comes the largest; rows that share an id follow each other by a hash of the
    text. A null text counts as empty. Fingerprints read ``place:hash place:hash ...``; likeness is the Jaccard
    measure of their hashes. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    buckets = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2)
    dealt, following = in_order(rows, buckets)
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - third)"), F.expr("left(next, third)"))
    df = dealt.withColumn("next", F.lead("text").over(following)).withColumn("third", third)
    df = df.withColumn("edited", edited).drop("next")
    df = with_fingerprint(df, "text", "kept", k, window)
    df = df.withColumn("n_chars", F.length("text").cast("long")).withColumn("sha", F.sha2(F.col("edited").cast("binary"), 256)).drop("text")
    df = with_fingerprint(df, "edited", "edited_kept", k, window).drop("edited")
    df = df.withColumn("h", hashes_of("kept")).withColumn("eh", hashes_of("edited_kept"))
    df = df.withColumn("nh", F.lead("h").over(following)).filter("own")
    return df.select(
        F.col("id").alias(id_col), "n_chars", F.col("sha").alias("edited_sha256"), as_text("kept").alias("fingerprint"),
        as_text("edited_kept").alias("edited_fingerprint"), likeness("h", "eh").alias("near_edited"), likeness("h", "nh").alias("near_next"),
    )
