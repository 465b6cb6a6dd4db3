"""One query for each operator over its whole table, with production parameters, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.llm.bpe import bpe_decode, bpe_encode, read_ranks
from tallywise.llm.collocations import collocations
from tallywise.llm.decontaminate import find_leaks
from tallywise.llm.jaccard_join import jaccard_join
from tallywise.llm.langid import held_out, identify, train
from tallywise.llm.line_dedup import dedup_lines
from tallywise.llm.merkle import verify_documents
from tallywise.llm.pii import pseudonymize_documents
from tallywise.llm.quality import assess
from tallywise.llm.span_dedup import dedup_spans
from tallywise.llm.suffix_dedup import dedup_substrings
from tallywise.llm.warc import read_warc, write_warc
from tallywise.llm.winnow import fingerprint_edits
from tallywise.session import Scratch
from tallywise.sources import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function: Callable) -> Callable:
    QUERIES[function.__name__] = function
    return function


@_query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return find_leaks(docs, read_table(spark, sf_dir, "benchmark"), Scratch(spark))


@_query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return assess(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"), Scratch(spark))


@_query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return pseudonymize_documents(docs, key=b"a key of the test tables").select("doc_id", "text", "n_found")


@_query
def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@_query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = identify(docs, train(docs.filter(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@_query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return jaccard_join(docs, Scratch(spark))[0].select("doc_id", "n_shingles", "component_id", "n_links")


@_query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read_table(spark, sf_dir, "documents", "doc_id", "text"), Scratch(spark))


@_query
def op7_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_spans(read_table(spark, sf_dir, "documents", "doc_id", "text"), Scratch(spark))


@_query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark).path("warc")
    write_warc(read_table(spark, sf_dir, "pages"), path)
    found = read_warc(spark, path)
    ids = (F.col("page").cast("long").alias("page_id"), F.col("refers_to").cast("long").alias("refers_to"))
    return found.select(*ids, "payload_bytes", "payload_digest", "record_type")


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def bpe_digests(docs: DataFrame) -> DataFrame:
    """The documents encoded and decoded, as digests."""
    ranks = read_ranks(public_tokenizers.path(VOCABULARY))
    decoded = bpe_decode(bpe_encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    digests = (F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
    return decoded.select("doc_id", "n_tokens", *digests)


@_query
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@_query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify_documents(read_table(spark, sf_dir, "documents"), Scratch(spark))


@_query
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = dedup_substrings(read_table(spark, sf_dir, "documents", "doc_id", "text"), Scratch(spark))
    n_removed = F.col("n_bytes") - F.octet_length("kept")
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return cut.select("doc_id", "n_bytes", n_removed.alias("n_removed"), n_spans, F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents", "lang", "text"), Scratch(spark))


WARC = """
with p as (select page_id, coalesce(html, '') as html from pages),
f as (select html, min(page_id) as first from p where strlen(html) >= 100 group by html)
select page_id, strlen(p.html) as payload_bytes, sha256(p.html) as payload_digest,
  case when first is null or first = page_id then 'response' else 'revisit' end as record_type,
  case when first <> page_id then first end as refers_to
from p left join f on p.html = f.html
"""

LINE_DEDUP = """
with docs as (select doc_id, text, string_split(text, chr(10)) as lines from documents),
windows as (
  select doc_id, i, lines[i] || chr(10) || lines[i + 1] as run
  from (select doc_id, lines, unnest(range(1, len(lines))) as i from docs)),
firsts as (select run, min((doc_id, i)) as first from windows group by run having count(*) > 1),
gone as (
  select distinct doc_id, unnest([i, i + 1]) as i
  from windows join firsts using (run) where (doc_id, i) <> first),
kept as (
  select doc_id, string_agg(lines[i], chr(10) order by i) as text
  from (select doc_id, lines, unnest(range(1, len(lines) + 1)) as i from docs) anti join gone using (doc_id, i)
  group by doc_id),
counts as (select doc_id, count(*) as n_removed from gone group by doc_id)
select d.doc_id, case when d.text is null then null else coalesce(k.text, '') end as text,
  coalesce(len(d.lines), 0) as n_lines, coalesce(c.n_removed, 0) as n_removed
from docs d left join kept k using (doc_id) left join counts c using (doc_id)
"""


# CRC-32 of a decimal number, bit by bit: a character is XORed in, then eight shifts (marked -1) follow.
CRC32 = """xor(4294967295, list_reduce(
  list_concat([4294967295::bigint], flatten(list_transform(range(1, len({s}) + 1),
    lambda i: [ord(({s})[i])::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: case when x >= 0 then xor(a, x) else xor(a // 2, 3988292384 * (a % 2)) end))"""

FIELDS = " || ".join(
    f"case when {c} is null then '-' else strlen({c}::varchar) || ':' || {c}::varchar end" for c in ("doc_id", "source", "lang", "{n_chars}", "text")
)

MERKLE = f"""
with recursive leaves as (
  select doc_id, lang, sha256({FIELDS.format(n_chars="n_chars")}) as leaf,
    case when {CRC32.format(s="doc_id::varchar")} % 7 = 0 then sha256({FIELDS.format(n_chars="(n_chars + 1)")}) end as tampered
  from documents),
places as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i from leaves),
tree as (
  select lang, 0 as lvl, i, leaf as h from places
  union all
  select lang, lvl + 1, i // 2, sha256(string_agg(h, '' order by i))
  from (select *, count(*) over (partition by lang) as n from tree) where n > 1 group by lang, lvl, i // 2),
subroots as (
  select *, row_number() over (order by lang nulls first) - 1 as l
  from (select lang, max(lvl) as height, arg_max(h, lvl) as subroot from tree group by lang)),
top as (
  select 0 as lvl, l as i, subroot as h from subroots
  union all
  select lvl + 1, i // 2, sha256(string_agg(h, '' order by i))
  from (select *, count(*) over () as n from top) where n > 1 group by lvl, i // 2),
total as (select max(lvl) as above, arg_max(h, lvl) as root from top),
folded as (
  select p.doc_id, p.lang, p.leaf, p.i, s.l, 0 as lvl, s.height, t.above, s.subroot, t.root,
    coalesce(tampered, leaf) as h, '' as proof
  from places p join subroots s on p.lang is not distinct from s.lang cross join total t
  union all
  select f.doc_id, f.lang, f.leaf, case when f.lvl < height then f.i // 2 else f.i end,
    case when f.lvl < height then f.l else f.l // 2 end, f.lvl + 1, height, above, subroot, root,
    sha256(case when (case when f.lvl < height then f.i else f.l end) % 2 = 1 then coalesce(a.h, b.h, '') || f.h
      else f.h || coalesce(a.h, b.h, '') end),
    proof || coalesce(a.h, b.h, '')
  from folded f
  left join tree a on f.lvl < height and a.lang is not distinct from f.lang and a.lvl = f.lvl and a.i = xor(f.i, 1)
  left join top b on f.lvl >= height and b.lvl = f.lvl - height and b.i = xor(f.l, 1)
  where f.lvl < height + above)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, h as folded_root, h = root as verified
from folded where lvl = height + above
"""


# A text's bytes that no repeated string covers lie in gaps between spans; hex digits put them together.
SUBSTRINGS = """
with docs as (
  select row_number() over () as r, doc_id, encode(coalesce(text, '')) as x, octet_length(encode(coalesce(text, ''))) as n
  from documents),
starts as (
  select r, i, md5(array_slice(x, i + 1, i + 200)) as s
  from (select r, x, unnest(range(0, n - 199)) as i from docs where n >= 200)),
repeated as (select r, i from starts where s in (select s from starts group by s having count(*) > 1)),
marked as (select r, i, i - lag(i) over (partition by r order by i) as step from repeated),
runs as (select r, i, count(*) filter (step is null or step > 200) over (partition by r order by i) as run from marked),
spans as (select r, run, min(i) as a, max(i) + 200 as b from runs group by r, run),
gaps as (
  select r, run, coalesce(lag(b) over w, 0) as a, a as b from spans window w as (partition by r order by run)
  union all select r, max(run) + 1, max(b), null from spans group by r),
kept as (select r, string_agg(hex(array_slice(x, a + 1, coalesce(b, n))), '' order by run) as h from gaps join docs using (r) group by r),
sums as (select r, sum(b - a) as n_removed, count(*) as n_spans from spans group by r)
select doc_id, n::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(coalesce(unhex(h), x)) as kept_sha256
from docs d left join sums using (r) left join kept using (r)
"""


COLLOCATIONS = r"""
with pieces as (
  select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as w
  from (select coalesce(lang, 'und') as lang, unnest(string_split_regex(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents)),
totals as (select lang, sum(len(w))::bigint as n from pieces group by lang),
grams as (
  select lang, w[i : i + m - 1] as g
  from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from pieces, (select unnest(range(1, 6)) as m))),
f as (select lang, g, count(*) as a from grams group by lang, g having count(*) >= 100),
cuts as (
  select c.lang, c.g, c.a, k, x.a as l, y.a as r, n, (1000::hugeint * c.a * n) // (x.a::hugeint * y.a) as score
  from (select lang, g, a, unnest(range(1, len(g))) as k from f) c
  join f x on x.lang = c.lang and x.g = c.g[1 : k] join f y on y.lang = c.lang and y.g = c.g[k + 1 : len(c.g)]
  join totals t on t.lang = c.lang),
best as (select * from cuts qualify row_number() over (partition by lang, g order by score, k) = 1),
inner_phrases as (
  select lang, g[i : i + m - 1] as g, max(a) as longest
  from (select lang, g, a, m, unnest(range(1, len(g) - m + 2)) as i from f, (select unnest(range(2, 5)) as m) where m < len(g))
  group by all),
kept as (
  select b.*, array_to_string(b.g, ' ') as phrase from best b left join inner_phrases i on i.lang = b.lang and i.g = b.g
  where longest is null or 100 * longest < 100 * b.a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score::bigint as score
from kept qualify rank <= 2000
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {"op6_line_dedup": LINE_DEDUP, "op10_warc": WARC, "op11_merkle": MERKLE, "op12_suffix_dedup": SUBSTRINGS, "op13_collocations": COLLOCATIONS}
