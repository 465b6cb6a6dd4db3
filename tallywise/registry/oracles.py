"""The registered queries in SQL, written apart from the Spark plans."""

from __future__ import annotations

from tallywise.registry.registered import BUCKETS, FEW, KEYWORDS, MOST_ROUNDS, STOP_WORDS, TOLERANCE

DELIMITERS = r"[ \t\n\r\f]+"


def _words(text: str) -> str:
    return f"unnest(list_filter(regexp_split_to_array({text}, '{DELIMITERS}'), lambda x: x <> ''))"


def _values(items: list[str]) -> str:
    return ", ".join(f"('{item}')" for item in items)


def _tokens(where: str = "true", table: str = "documents") -> str:
    return f"select doc_id, {_words('text')} as word from {table} where {where}"


STOP = f"stop(word) as (values {_values(STOP_WORDS)})"

KEPT = f"""
  {STOP},
  tokens as ({_tokens()}),
  kept as (select doc_id, word as term from tokens
           where not exists (select 1 from stop where stop.word = tokens.word))"""

WEIGHTS = f"""{KEPT},
  tf as (select doc_id, term, count(*) as tf from kept group by doc_id, term),
  df as (select term, count(*) as df from tf group by term),
  n as (select count(distinct doc_id) as n_docs from documents),
  weighted as (
    select doc_id, term, tf, df, (1 + ln(tf)) * ln(n_docs / df) as tfidf
    from tf join df using (term) cross join n),
  norms as (select doc_id, sqrt(sum(tfidf * tfidf)) as norm from weighted group by doc_id),
  normalized as (
    select doc_id, term, case when norm = 0 then 0.0 else tfidf / norm end as weight
    from weighted join norms using (doc_id))"""



def _scores(name: str, keywords: list[str]) -> str:
    return f"""
  {name} as (
    select doc_id, round(sum(weight), 9) as score from normalized
    where term in (select col0 from (values {_values(keywords)})) group by doc_id)"""


RELEVANCE = f"{WEIGHTS}, {_scores('scores', KEYWORDS)}"

SIDES = f"""
  {STOP},
  en as (select word from ({_tokens("lang = 'en'")})
         where word not in (select word from stop)),
  fr as (select word from ({_tokens("lang = 'fr'")})
         where word not in (select word from stop)),
  shared as (
    select word, least(a.n, b.n) as n
    from (select word, count(*) as n from en group by word) a
    join (select word, count(*) as n from fr group by word) b using (word))"""

PART_SUPPLIER = """
  edges as materialized (
    select 'P' || l_partkey as src, 'S' || l_suppkey as dst from lineitem
    union all
    select 'S' || l_suppkey, 'P' || l_partkey from lineitem),
  nodes as materialized (select distinct src as id from edges)"""

CUSTOMER_NATION_REGION = """
  edges as materialized (
    select 'C' || c_custkey as src, 'N' || c_nationkey as dst from customer
    union all
    select 'N' || n_nationkey, 'R' || n_regionkey from nation),
  nodes as materialized (
    select 'C' || c_custkey as id from customer
    union all select 'N' || n_nationkey from nation
    union all select 'R' || r_regionkey from region)"""


SEARCH_BATCH = f"""
  with {WEIGHTS},
  asked as (select distinct item_id, {_words("text")} as term from benchmark),
  scores as (
    select item_id, doc_id, round(sum(weight), 9) as score
    from normalized join asked using (term) group by item_id, doc_id)
  select item_id, score, doc_id from scores
  qualify rank() over (partition by item_id order by score desc) <= 3"""

BY_ROOT = """(
  select doc_id % (select ceil(sqrt(count(*)))::bigint from documents where text is not null and doc_id is not null) as bucket, text
  from documents where text is not null and doc_id is not null)"""

BY_BUCKET = f"(select doc_id % {BUCKETS} as bucket, text from documents where text is not null)"


def _rounds(graph: str, rounds: int) -> str:
    """Common tables ``r0`` to ``r<rounds>``, the ranks after each round."""
    steps = [
        graph,
        "degrees as materialized (select src, count(*) as out_degree from edges group by src)",
        "total as materialized (select count(*) as n from nodes)",
        "r0 as (select id, cast(1 as double) as rank from nodes)",
    ]
    for i in range(rounds):
        steps.append(
            f"""s{i} as (
    select e.dst as id, sum(r.rank / d.out_degree) as s
    from edges e join degrees d on d.src = e.src join r{i} r on r.id = e.src group by e.dst),
  r{i + 1} as materialized (
    select nodes.id, 0.15 / n + 0.85 * coalesce(s, 0) as rank
    from nodes left join s{i} using (id) cross join total)"""
        )
    return ",\n  ".join(steps)


def oracle_sql() -> dict[str, str]:
    out_degrees = "select e.src, e.dst, d.out_degree from edges e join degrees d using (src)"
    return {
        "text_scan": rf"""
            select lang, n_lines, n_lines as n_named, n_words from (
              select lang,
                sum(len(regexp_split_to_array(text, '\r\n|\r|\n')))::bigint as n_lines,
                sum(len(list_filter(regexp_split_to_array(text, '{DELIMITERS}'),
                    lambda x: x <> '')))::bigint as n_words
              from documents group by lang)""",
        "tokenize": _tokens(),
        "word_count": f"select word, count(*) as n from ({_tokens()}) group by word",
        "word_count_ordered": f"""
            select word, n, row_number() over (order by word) as place from (
              select word, count(*) as n from ({_tokens()}) group by word)""",
        "tsv_roundtrip": f"select word, count(*) as n from ({_tokens()}) group by word",
        "word_count_union": f"""
            select word, count(*) as n from (
              select {_words("text")} as word from documents
              union all
              select {_words("text")} as word from conversations) group by word""",
        "stopword_filter": f"with {KEPT} select doc_id, term as word from kept",
        "word_count_nostop": f"with {KEPT} select term as word, count(*) as n from kept group by term",
        "common_words": f"with {SIDES} select word, n from shared",
        "common_words_onepass": f"""
            with {SIDES} select word, count(*) as n from (
              select word from en intersect all select word from fr) group by word""",
        "common_words_sorted": f"with {SIDES} select n, word from shared order by n, word",
        "topk_common_words": f"""
            with {SIDES} select n, word from shared
            qualify rank() over (order by n desc) <= 20 order by n desc, word""",
        "term_frequency": f"""
            with {KEPT} select doc_id, term, count(*) as tf from kept group by doc_id, term""",
        "doc_frequency": f"""
            with {KEPT}, tf as (
              select doc_id, term, count(*) as tf from kept group by doc_id, term)
            select doc_id, term, tf, count(*) over (partition by term) as df from tf""",
        "tfidf": f"with {WEIGHTS} select doc_id, term, round(tfidf, 9) as tfidf from weighted",
        "tfidf_normalized": f"""
            with {WEIGHTS} select doc_id, term, round(weight, 9) as weight from normalized""",
        "query_terms": f"select distinct item_id, {_words('text')} as term from benchmark",
        "doc_relevance": f"with {RELEVANCE} select doc_id, score from scores",
        "topk_documents": f"""
            with {RELEVANCE} select score, doc_id from scores
            qualify rank() over (order by score desc) <= 3 order by score desc, doc_id""",
        "search_batch": SEARCH_BATCH,
        "search_batch_shuffled": SEARCH_BATCH,
        "search_index": f"""
            with {WEIGHTS}, {_scores("many", KEYWORDS)}, {_scores("few", FEW)}
            select 0 as query, score, doc_id from many qualify rank() over (order by score desc) <= 3
            union all
            select 1 as query, score, doc_id from few qualify rank() over (order by score desc) <= 3""",
        "search_index_batch": SEARCH_BATCH,
        "search_files": f"""
            with {RELEVANCE.replace("doc_id", "bucket").replace("from documents", f"from {BY_BUCKET}")}
            select score, bucket from scores qualify rank() over (order by score desc) <= 3""",
        "search_growing_files": f"""
            with {WEIGHTS.replace("doc_id", "bucket").replace("from documents", f"from {BY_ROOT}")},
            asked as (
              select distinct {_words("line")} as term
              from (select regexp_split_to_array(text, '\r\n|\r|\n')[1] as line from benchmark order by item_id limit 1)),
            scores as (select bucket, round(sum(weight), 9) as score from normalized join asked using (term) group by bucket)
            select score, bucket from scores qualify rank() over (order by score desc) <= 3""",
        "graph_edges": f"with {_rounds(PART_SUPPLIER, 0)} {out_degrees}",
        "adjacency_roundtrip": f"with {_rounds(PART_SUPPLIER, 0)} {out_degrees}",
        "adjacency_hub": f"""
            with {PART_SUPPLIER}
            select src, dst, count(*) as copies, 1 as n_lines from (
              from edges union all select 'H', 'P' || l_partkey from lineitem) group by src, dst""",
        "pagerank_contribs": f"""
            with {_rounds(PART_SUPPLIER, 0)}
            select e.src, e.dst, round(rank / out_degree, 9) as credit
            from edges e join degrees d using (src) join r0 on r0.id = e.src""",
        "pagerank_step": f"""
            with {_rounds(PART_SUPPLIER, 1)} select id, round(rank, 9) as rank from r1""",
        "pagerank": f"""
            with {_rounds(PART_SUPPLIER, 10)} select id, round(rank, 9) as rank from r10""",
        "pagerank_tol": f"""
            with recursive {_rounds(PART_SUPPLIER, 0)},
            loop as (
              select id, rank, 0 as round, cast('inf' as double) as change from r0
              union all
              select id, rank, round, max(abs(rank - before)) over () from (
                select p.id, 0.15 / n + 0.85 * coalesce(s, 0) as rank, p.rank as before, p.round + 1 as round
                from loop p cross join total left join (
                  select e.dst, sum(q.rank / d.out_degree) as s
                  from edges e join degrees d on d.src = e.src join loop q on q.id = e.src group by e.dst) c on c.dst = p.id
                where p.change > {TOLERANCE} and p.round < {MOST_ROUNDS}))
            select id, round(rank, 9) as rank from loop where round = (select max(round) from loop)""",
        "pagerank_dangling": f"""
            with {_rounds(CUSTOMER_NATION_REGION, 10)}
            select id, round(rank, 9) as rank from r10""",
        "ranked_adjacency_roundtrip": f"""
            with {_rounds(CUSTOMER_NATION_REGION, 1)}
            select id, round(rank, 9) as rank, coalesce(out_degree, 0) as out_degree
            from r1 left join degrees on src = id""",
    }
