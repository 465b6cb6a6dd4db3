"""Edge cases of all operators, and brute-force versions where SQL can't express one."""

from __future__ import annotations

import gzip
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken
from conftest import TESTDATA
from pyspark.sql import functions as F

import corpus_pipeline
from tallywise.llm import bpe, pii, registered, winnow
from tallywise.llm.decontaminate import find_leaks, smith_waterman
from tallywise.llm.jaccard_join import _near, _parity, _placed, _sets, jaccard_components, jaccard_join
from tallywise.llm.langid import identify, train
from tallywise.llm.line_dedup import dedup_lines
from tallywise.llm.quality import assess
from tallywise.llm.span_dedup import dedup_spans
from tallywise.llm.warc import read_warc, write_warc
from tallywise.session import Scratch

FOLDER = str(TESTDATA / "sf0.001")
SCHEMA = "doc_id long, text string, key long, id string, cls int"  # the last three clash with inner names
LONG = " ".join(f"w{i}" for i in range(30_000))
ODD = [
    (1, "", 0, "", 0), (2, None, 0, None, None), (None, "a b c d e f g", 0, "", 0), (4, LONG, 0, "", 0),
    (5, "a b c d e f g", 0, "", 0), (5, "a b c d e f g", 0, "", 0), (6, " \n\n ", 0, "", 0), (7, "é漢🙂 x", 0, "", 0),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_jaccard_brute_force(spark, docs):
    sets = {}
    for row in docs.collect():
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), row.text.encode()))
        sets[row.doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}
    for _ in range(len(sets)):
        for a, x in sets.items():
            for b, y in sets.items():
                if a < b and x and 100 * len(x & y) >= 75 * len(x | y):
                    parent[a] = parent[b] = min(parent[a], parent[b])
        break
    got = {r.doc_id: r for r in jaccard_components(docs, Scratch(spark)).collect()}
    assert {i: len(s) for i, s in sets.items()} == {i: r.n_shingles for i, r in got.items()}
    linked = {(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert all(got[a].component_id == got[b].component_id for a, b in linked)
    least = {i: i for i in sets}
    for _ in sets:
        for a, b in linked:
            least[a] = least[b] = min(least[a], least[b])
    assert {i: r.component_id for i, r in got.items()} == least


def test_jaccard_sets_are_made_for_little_text_at_a_time():
    texts = [" ".join(f"w{i}x{j}" for j in range(200)) for i in range(1000)]
    batch = pa.record_batch([pa.array(range(1000)), pa.array(texts)], ["id", "text"])
    parts = list(_sets(iter([batch]), 5))
    assert sum(len(part) for part, _, _ in parts) == 1000 and all(len(s) == 196 for _, sets, _ in parts for s in sets)
    assert max(sum(map(len, part["text"].to_pylist())) for part, _, _ in parts) <= 1 << 19


def test_jaccard_odd(spark, odd):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(odd, Scratch(spark)).collect()]
    assert sorted(got, key=repr) == sorted(
        [(1, 0, 1), (2, 0, 2), (None, 3, 5), (4, 29_996, 4), (5, 3, 5), (5, 3, 5), (6, 0, 6), (7, 1, 7)], key=repr
    )
    assert jaccard_components(odd.limit(0), Scratch(spark)).count() == 0


def test_jaccard_links_brute_force(spark, monkeypatch):
    """Every link comes out, also between two texts that others have already connected, over several blocks."""
    monkeypatch.setattr("tallywise.llm.jaccard_join.BLOCK", 4)
    chance, rows = random.Random(5), []
    for group in range(3):
        base = [f"g{group}w{i}" for i in range(60 + 15 * group)]
        for _ in range(14):
            text, cut = list(base), chance.randint(0, 20)
            text[chance.randrange(len(text))] = f"x{chance.randint(0, 3)}"
            rows.append((len(rows), " ".join(text[cut:])))
    rows += [(100, rows[0][1]), (100, rows[0][1]), (None, rows[1][1]), (101, ""), (102, None), (103, "alone in the whole wide world")]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in ((t or "").split() for _, t in rows)]
    linked = [[k != j and bool(x) and 100 * len(x & y) >= 75 * len(x | y) for k, y in enumerate(sets)] for j, x in enumerate(sets)]
    documents, links = jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), Scratch(spark))
    got = documents.collect()
    assert sorted(((r.doc_id, r.n_links) for r in got), key=repr) == sorted(((i, sum(x)) for (i, _), x in zip(rows, linked, strict=True)), key=repr)
    cls = {r.doc_id: r.cls for r in got}
    want = {tuple(sorted((cls[a[0]], cls[b[0]]))) for a, x in zip(rows, linked, strict=True) for b, y in zip(rows, x, strict=True) if y and cls[a[0]] != cls[b[0]]}
    pairs = [(r.a, r.b) for r in links.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want and len(want) > 50


def test_jaccard_parities_keep_all_links_and_few_others():
    """Candidates are told apart without their sets; no pair that links goes, also between unlike table sizes."""
    chance, rows, linked = random.Random(3), [], []
    for i in range(600):
        size, other = chance.randint(1, 700), chance.random() if i % 2 else 0.2 * chance.random()
        x = {chance.getrandbits(56) for _ in range(size)}
        y = {h if chance.random() > other else chance.getrandbits(56) for h in x} | {chance.getrandbits(56) for _ in range(size // 8 * (i % 3))}
        linked.append(100 * len(x & y) >= 75 * len(x | y))
        rows.append((i, -i, len(x), len(y), *(_parity(np.array(sorted(s), np.uint64)) for s in (x, y))))
    batch = pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], ["a", "b", "size_a", "size_b", "pa", "pb"])
    kept = set(next(_near(75)(iter([batch])))["a"].to_pylist())
    assert {i for i, x in enumerate(linked) if x} <= kept and sum(linked) > 50
    assert len(kept) < 0.8 * len(rows) and all(len(r[4]) <= max(8, r[2] / 4) for r in rows)


def test_jaccard_sets_of_a_small_component_are_sent_once(spark):
    """A component that fits a block is one block, whatever its sizes; of a larger one all like sizes meet."""
    rows = [(1, i, 1, 100 + 15 * i, 0) for i in range(20)] + [(2, 1000 + i, 1, 50, 0) for i in range(3000)]
    placed = _placed(spark.createDataFrame(rows, "label long, cls long, weight long, size long, copy long"), 75).collect()
    meets = {r.cls: {tuple(m)[:4] for m in r.m} for r in placed}
    assert len(meets) == len(rows) and all(len(r.m) == len(meets[r.cls]) for r in placed)
    assert {frozenset(meets[i]) for i in range(20)} == {frozenset({(0, 0, 0, 0)})}
    kinds = {frozenset(meets[1000 + i]) for i in range(3000)}
    assert len(kinds) == 4 and all(len(x & y) == 1 for x in kinds for y in kinds if x != y)


def test_jaccard_plans_stay_small(spark, docs, monkeypatch):
    """No query holds the steps of others many times over: the driver keeps the plan of each, with every change of it."""
    shuffles, write = {}, Scratch.write

    def counted(scratch, df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles[name] = max(shuffles.get(name, 0), plan.count("Exchange "))
        return write(scratch, df, name)

    monkeypatch.setattr(Scratch, "write", counted)
    documents, _ = jaccard_join(docs, Scratch(spark))
    assert documents.count() == docs.count()
    assert {"placed", "across", "labels", "links"} <= set(shuffles) and max(shuffles.values()) <= 30, shuffles


def fingerprint(text, hashes, k=winnow.K, window=winnow.WINDOW):
    single = [hashes[w] for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    grams = []
    for i in range(len(single) - k + 1):
        total = 0
        for h in single[i : i + k]:
            total = (total * winnow.BASE + h) % winnow.PRIME
        grams.append(total)
    kept = []
    for i in range(max(len(grams) - window + 1, min(1, len(grams)))):
        part = grams[i : i + window]
        place = i + max(j for j, h in enumerate(part) if h == min(part))
        if not kept or kept[-1] != (place, min(part)):
            kept.append((place, min(part)))
    return " ".join(f"{p}:{h:x}" for p, h in kept)


def test_winnowing_brute_force(spark, docs):
    few = docs.filter("doc_id < 40")
    cut = few.select(F.explode(F.split("text", r"[\x20\x09-\x0D]+")).alias("w")).distinct()
    hashes = {r.w: r.h for r in cut.select("w", F.pmod(F.xxhash64("w"), F.lit(winnow.PRIME)).alias("h")).collect()}
    texts = {r.doc_id: r.text for r in few.collect()}
    for row in winnow.fingerprint_edits(few).collect():
        if len(texts[row.doc_id].split()) >= winnow.K:
            assert row.fingerprint == fingerprint(texts[row.doc_id], hashes)


def test_winnowing_odd(spark, odd):
    rows = winnow.fingerprint_edits(odd).collect()
    assert len(rows) == len(ODD)
    assert {r.fingerprint for r in rows if r.doc_id in (1, 2, 6)} == {""}
    assert len({r.fingerprint for r in rows if r.doc_id == 5}) == 1
    assert winnow.fingerprint_edits(odd.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["", " ", "a" * 2000, "ab" * 500, "it's  12 we\x1c\x85 é漢🙂\n\n x", "\n\t a  b "])
def test_bpe_equals_tiktoken(text):
    ranks = bpe.read_ranks(public_tokenizers.path(registered.VOCABULARY))
    ours = np.frombuffer(bpe.Encoder(ranks, public_tokenizers.PATTERN).encode(text), "<u4").tolist()
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert ours == theirs.encode_ordinary(text)


def test_bpe_of_many_texts_at_once(monkeypatch):
    """All pre-tokens go through the queue together, in more than one group."""
    monkeypatch.setattr(bpe, "GROUP_BYTES", 50_000)
    ranks = bpe.read_ranks(public_tokenizers.path(registered.VOCABULARY))
    exact = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    chance = random.Random(3)
    texts = ["".join(chance.choices("aAbtehin \n\u00e9\u6f22", k=chance.randint(0, 300))) for _ in range(1500)]
    texts += ["a" * 5000, "ab" * 3000, "", "  x", "".join(chance.choices("etaoinshr", k=30_000))]
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    for _ in range(2):  # the second time all are known
        got = encoder.encode_all(texts)
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [exact.encode_ordinary(x) for x in texts]
    with pytest.raises(ValueError, match="lacks"):
        bpe.RankQueue({b"a": 0}).encode([b"ab"])


def test_bpe_round_trip(spark, odd):
    got = registered.bpe_digests(odd.select("doc_id", "text"))
    want = odd.select(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("d"))
    assert sorted(r.decoded_sha256 for r in got.collect()) == sorted(r.d for r in want.collect())
    assert registered.bpe_digests(odd.limit(0)).count() == 0


def test_lines(spark, odd):
    rows = spark.createDataFrame([(1, "a\nb\nc"), (2, "x\na\nb\ny"), (3, "a\nz"), (4, None), (5, "")], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in dedup_lines(rows, Scratch(spark)).collect()}
    assert got == {1: ("a\nb\nc", 3, 0), 2: ("x\ny", 4, 2), 3: ("a\nz", 2, 0), 4: (None, 0, 0), 5: ("", 1, 0)}
    assert dedup_lines(odd, Scratch(spark)).count() == len(ODD)
    assert dedup_lines(odd.limit(0), Scratch(spark)).count() == 0


def test_spans(spark, odd):
    shared = "One two three four five six. Seven eight nine ten eleven."
    rows = spark.createDataFrame([(1, f"Start. {shared} End."), (2, f"Other. {shared} Last."), (3, "Clean. Text.")], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_removed) for r in dedup_spans(rows, Scratch(spark)).collect()}
    assert got == {1: (f"Start. {shared} End.", 0), 2: ("Other. Last.", 2), 3: ("Clean. Text.", 0)}
    assert dedup_spans(odd, Scratch(spark)).count() == len(ODD)
    assert dedup_spans(odd.limit(0), Scratch(spark)).count() == 0


def test_spans_brute_force(spark):
    """All runs of 2 sentences and 10 words or more, of any length, against the operator; their ends
    are often short sentences."""
    chance, texts = random.Random(2), []
    passages = [" ".join(" ".join(f"p{k}s{j}w{i}" for i in range(chance.choice((1, 1, 2, 4, 7)))) + "." for j in range(8)) for k in range(4)]
    for i in range(30):
        cut = chance.choice(passages).split(". ")
        a = chance.randint(0, 3)
        texts.append(f"Only{i} here{i}. " + ". ".join(cut[a : a + chance.randint(2, 8)]).rstrip(".") + f". Own{i} end{i}.")
    seen, want = {}, {}
    for i, text in enumerate(texts):
        sentences = [x.rstrip(".").split() for x in text.split(". ")]
        for a in range(len(sentences)):
            for b in range(a + 2, len(sentences) + 1):
                if sum(map(len, sentences[a:b])) >= 10:
                    seen.setdefault(tuple(map(tuple, sentences[a:b])), []).append((i, a, b))
        want[i] = set()
    for places in seen.values():
        for i, a, b in sorted(places)[1:]:
            want[i] |= set(range(a, b))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.text.split(), r.n_removed) for r in dedup_spans(rows, Scratch(spark)).collect()}
    for i, text in enumerate(texts):
        left = [x for j, x in enumerate(re.findall(r"[^.]+\.", text)) if j not in want[i]]
        assert got[i] == (" ".join(left).split(), len(want[i]))


def test_leaks(spark, odd):
    item = [f"term{i}" for i in range(20)]
    edited = [w if i % 5 else f"new{i}" for i, w in enumerate(item)]
    rows = [(1, f"x {' '.join(item)} y"), (2, f"q r {' '.join(edited)} s"), (3, "term1 term2 term3 only"), (4, None)]
    frame, tests = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(9, " ".join(item)), (8, "a b"), (7, None)], "item_id long, text string")
    got = {r.doc_id: r for r in find_leaks(frame, tests, Scratch(spark)).collect()}
    assert set(got) == {1, 2} and got[1].score == 1.0 and (got[1].first_word, got[1].last_word) == (1, 21)
    assert 0.5 <= got[2].score < 1
    assert find_leaks(odd, tests, Scratch(spark)).count() == find_leaks(odd.limit(0), tests.limit(0), Scratch(spark)).count() == 0


def test_alignment():
    item = np.array([1, 2, 3, 4, 5], np.uint64)
    score, end = smith_waterman([item, item], [np.array([9, 1, 2, 7, 4, 5, 9], np.uint64), np.array([1, 2, 3, 8, 4, 5], np.uint64)])
    assert score.tolist() == [7, 9] and end.tolist() == [6, 6]


def test_language(spark, odd):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    got = registered.op4_language(spark, f"{TESTDATA}/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang = lang_pred").count() >= 0.97 * got.count()
    found = {r.doc_id: r.lang_pred for r in identify(odd, train(docs)).collect() if r.doc_id in (1, 2, 6)}
    assert set(found.values()) == {"und"}
    mixed = docs.filter("lang = 'de'").limit(1).crossJoin(docs.filter("lang = 'fr'").limit(1).select(F.col("text").alias("t2")))
    spans = identify(mixed.select("doc_id", F.concat_ws(" ", "text", "t2").alias("text")), train(docs)).first().spans
    assert [s.lang for s in spans] == ["de", "fr"]
    assert {r.lang_pred for r in identify(odd, train(docs.limit(0))).collect()} == {"und"}


def test_quality(spark, odd):
    labels = spark.read.parquet(f"{TESTDATA}/sf0.01/labels.parquet")
    got = registered.op2_quality(spark, f"{TESTDATA}/sf0.01").join(labels, "doc_id").filter("held_out")
    assert got.filter("predicted = quality").count() >= 0.95 * got.count()
    few = assess(odd, labels, Scratch(spark))
    assert few.count() == len(ODD) and few.filter("score between 0 and 1").count() == len(ODD)
    assert assess(odd.limit(0), labels.limit(0), Scratch(spark)).count() == 0


def test_pseudonyms(spark, odd):
    key = b"k"
    for size in (2, 10, 97, 1000):
        assert sorted(pii.permute(v, size, key, "t") for v in range(size)) == list(range(size))
    text = "mail bo.1@x.org card 4539578763621486 ip 10.0.0.255 on 2024-02-29 or 999.1.1.1 card 4539578763621487"
    new, found = pii.pseudonymize(text, key, {})
    assert [new[a:b] != text[a:b] for a, b, _ in found] and [k for *_, k in found] == ["email", "card", "ip", "date"]
    card = next(new[a:b] for a, b, k in found if k == "card")
    assert pii.luhn(card) == 0 and "999.1.1.1" in new and "4539578763621487" in new
    assert pii.pseudonymize(text, key, {})[0] == new
    assert pii.pseudonymize_documents(odd, key).count() == len(ODD)
    assert pii.pseudonymize_documents(odd.limit(0), key).count() == 0


@pytest.mark.parametrize(
    ("text", "value", "kind"),
    [
        ("4111 1111 1111 1111 123", "4111 1111 1111 1111", "card"),
        ("4111 1111 1111 1111 12/25", "4111 1111 1111 1111", "card"),
        ("4111111111111111 5 items", "4111111111111111", "card"),
        ("Paid.4111-1111-1111-1111.", "4111-1111-1111-1111", "card"),
        ("ES9121000418450200051332 2024", "ES9121000418450200051332", "iban"),
        ("ES91 2100 0418 4502 0005 1332 EUR", "ES91 2100 0418 4502 0005 1332", "iban"),
        ("to DE89370400440532013000 INVOICE", "DE89370400440532013000", "iban"),
        ('TOKEN = "Ab3xY9zQ"', "Ab3xY9zQ", "password"),
        ('{"password": "hunter2x"}', "hunter2x", "password"),
        ("KEY 9233A8EC01B7D5F49233A8EC01B7D5F4", "9233A8EC01B7D5F49233A8EC01B7D5F4", "hex_key"),
        ("key 9233a8EC01b7d5f49233A8ec01B7D5F4", "9233a8EC01b7d5f49233A8ec01B7D5F4", "hex_key"),
    ],
)
def test_pseudonyms_beside_other_text(text, value, kind):
    new, found = pii.pseudonymize(text, b"k", {})
    assert [k for *_, k in found] == [kind] and value not in new
    before, after = text.split(value)
    assert new.startswith(before) and new.endswith(after) and len(new) == len(text)
    left = new[len(before) : len(new) - len(after)]
    assert re.sub(r"[A-Z]", "A", re.sub(r"\d", "A", left)).isupper() == value.isupper() or kind in ("card", "password")
    if kind == "card":
        assert pii.luhn(re.sub(r"\D", "", left)) == 0
    if kind == "iban":
        assert left[:2] == value[:2] and pii._iban(left, b"k") is not None


def test_warc(spark):
    body = "é" * 60
    rows = [(1, "u", body), (2, "v", body), (3, None, None), (4, "w", "x"), (5, "y", "x"), (None, "z", body), (6, "a\nb", "b" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(0))
    path = Scratch(spark).path("warc")
    write_warc(pages, path)
    got = {r.page: (r.record_type, r.refers_to, r.payload_bytes) for r in read_warc(spark, path).collect()}
    assert got == {
        "1": ("response", None, 120), "2": ("revisit", "1", 120), None: ("revisit", "1", 120), "3": ("response", None, 0),
        "4": ("response", None, 1), "5": ("response", None, 1), "6": ("response", None, 300_000),
    }
    empty = Scratch(spark).path("empty")
    write_warc(pages.limit(0), empty)
    assert read_warc(spark, empty).count() == 0


def test_warc_ranges_are_read_in_many_tasks(spark, monkeypatch):
    """With adaptive execution on, as many partitions as there are ranges, and records in several of them."""
    monkeypatch.setattr("tallywise.llm.warc.RANGE", 2000)
    pages = spark.createDataFrame([(i, f"u{i}", random.Random(i).randbytes(600).hex()) for i in range(60)], "page_id long, url string, html string")
    path = Scratch(spark).path("many")
    write_warc(pages, path)
    read = read_warc(spark, path)
    size = sum(r.length for r in spark.read.format("binaryFile").load(path).select("length").collect())
    assert read.rdd.getNumPartitions() >= size // 2000
    used = read.select("page", F.spark_partition_id().alias("p")).collect()
    assert len({r.page for r in used}) == 60 and len({r.p for r in used}) > size // 2000 // 3


def test_warc_of_other_archives(spark, tmp_path):
    """A record that is cut off or corrupt raises with its place; records without an HTTP header come out."""

    def record(kind, content, block):
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{kind}>\r\nContent-Type: {content}\r\nContent-Length: {len(block)}\r\n\r\n"
        return gzip.compress(head.encode() + block + b"\r\n\r\n", mtime=0)

    noise = random.Random(1).randbytes(20_000)
    info, request = record("warcinfo", "application/warc-fields", b"software: x\r\n"), record("request", "application/http; msgtype=request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n")
    page = record("response", "application/http; msgtype=response", b"HTTP/1.1 200 OK\r\n\r\n" + noise)
    cases = {"whole": info + request + page, "cut": info + page[:9000], "early": info + page[:300], "bad": info + page[:10_000] + bytes(500) + page[10_500:] + info}
    for name, data in cases.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.warc.gz").write_bytes(data)
    got = {r.record_type: (r.page, r.payload_bytes, len(r.payload)) for r in read_warc(spark, str(tmp_path / "whole")).collect()}
    assert got == {"warcinfo": ("warcinfo", 13, 13), "request": ("request", 0, 0), "response": ("response", 20_000, 20_000)}
    for name in ("cut", "early", "bad"):
        with pytest.raises(Exception, match=f"the record at byte {len(info)} of .*a.warc.gz"):
            read_warc(spark, str(tmp_path / name)).collect()


@pytest.mark.parametrize("key", sorted(registered.oracle_sql()))
def test_query_equals_oracle(spark, key):
    db = duckdb.connect()
    for path in (TESTDATA / "sf0.001").glob("*.parquet"):
        db.execute(f"create view {path.stem} as select * from '{path}'")
    want = db.execute(registered.oracle_sql()[key])
    names = [d[0] for d in want.description]
    assert sorted(map(repr, (tuple(r) for r in registered.queries()[key](spark, FOLDER).select(*names).collect()))) == sorted(map(repr, want.fetchall()))


def test_pipeline(spark, docs):
    out = corpus_pipeline.run(spark, FOLDER)
    assert 0 < out.count() <= docs.count()


def _stage(spark, name, rows, folder=FOLDER):
    """What a stage leaves of rows (doc_id, text, lang, source), sorted."""
    frame = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = dict(corpus_pipeline.STAGES)[name](spark, frame, folder)
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)


def test_pipeline_stages_keep_rows_of_null_and_repeated_ids(spark, docs, tmp_path):
    """Against brute force: a row is told from others by doc_id and text, and stays once."""
    few = docs.orderBy("doc_id").filter("lang = 'en'").limit(6).collect()
    a, b, c, d, e, f = ("\n".join(r.text.split("\n")[:1]) + f" own{i}" for i, r in enumerate(few))
    base = [(None, a), (None, b), (None, a), (7, c), (7, d), (7, c), (8, e), (8, "12 34"), (None, "12 34"), (9, None), (None, None)]
    rows = [(*r, "en", "s") for r in base]

    def want(keep):
        return sorted({r for r in base if keep(r[1])}, key=repr)

    assert _stage(spark, "language", rows) == want(lambda t: t is not None and t != "12 34")
    # One line each: nothing is a run.
    assert _stage(spark, "lines", rows) == want(lambda t: True)
    run = [(None, "x\ny\nz"), (3, "p\nx\ny"), (3, "q\nx\ny"), (None, "x\ny"), (3, "p\nx\ny")]
    frame = spark.createDataFrame([(t,) for _, t in run], "text string")
    hashes = {r.text: r.h for r in frame.select("text", F.xxhash64("text").alias("h")).collect()}
    seen, left = set(), []
    for i, t in sorted(set(run), key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]])):
        cut = t.split("\n")
        gone = {k for j in range(len(cut) - 1) if (cut[j], cut[j + 1]) in seen for k in (j, j + 1)}
        seen |= set(zip(cut[:-1], cut[1:], strict=True))
        left.append((i, "\n".join(x for j, x in enumerate(cut) if j not in gone)))
    assert _stage(spark, "lines", [(*r, "en", f"s{k}") for k, r in enumerate(run)]) == sorted((r for r in left if r[1]), key=repr)
    # Near copies: a stands without and with ids; c and d share theirs.
    near = [*rows, (5, a, "en", "s"), (6, a, "en", "s"), (7, f, "en", "s"), (9, f, "en", "s")]
    got = _stage(spark, "near_duplicates", near)
    assert got == sorted({(5, a), (None, b), (7, c), (7, d), (8, e), (7, f), (8, "12 34"), (9, None), (None, None)}, key=repr)
    spark.createDataFrame([(1, c), (2, b)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert _stage(spark, "decontaminate", rows, str(tmp_path)) == want(lambda t: t not in (c, b))
