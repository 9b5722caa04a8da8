"""Every operator over small tables with everything that may go wrong, against plain versions."""

import os
import random
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import plain  # noqa: E402

from newsflow.llm import exact_dedup, lexicon, line_dedup, near_dup, packing, pii, quality, queries, sharding, token_counts, toxicity  # noqa: E402
from newsflow.llm.common import configure  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for their own columns.
CLASHES = ("key", "n", "first", "second", "shard", "host", "row", "ids", "score", "label", "base", "spans", "node", "cluster", "a", "b",
           "slot", "kind", "c", "turn", "cells", "lines", "content", "shingle", "root", "_doc", "_toxic", "predicted", "start", "length")


def rows():
    rng = random.Random(11)
    word = lambda: rng.choice(["tion", "ing", "over", "naïve", "Étre", "sun", "moon", "x9", "日本", "a", "the", "of", "run", "wild"])
    line = lambda n: " ".join(word() for _ in range(n))
    shared, base = line(12), line(90)
    out = [(i, "\n".join([line(rng.randint(1, 30)) for _ in range(rng.randint(1, 6))] + ([shared] if i % 3 == 0 else []))) for i in range(40)]
    for i in range(40, 60):  # near copies, some of them past the limit
        words = base.split()
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(90)] = f"w{rng.randrange(99)}"
        out.append((i, " ".join(words)))
    out += [(60 + i, out[3][1]) for i in range(4)] + [(70, out[3][1].replace(" ", "\t ")), (71, out[3][1].upper())]
    out += [(80, None), (81, ""), (82, " \n\t"), (83, "one"), (84, "one two three four"), (85, "ONE two\nthree four"), (86, "\n\n\n")]
    out += [(90, "mail bob.k@x1.example.org or +1 (212) 555-0123 4111 1111 1111 1111\n10.0.0.255 256.1.1.1 1.2.3.4.5 password=hunter2hunter2")]
    out += [(91, "long " * 30_000), (92, "7" * 50_000), (93, "4111111111111111 " * 300), (94, "1," * 20_000), (95, "<|endoftext|> a\x1cb")]
    out += [(None, shared + "\nno id"), (None, shared), (10, out[10][1]), (10, out[10][1]), (11, shared), (-5, base)]
    rng.shuffle(out)
    return out


ROWS = rows()


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    """The rows as a table with many more columns, and labels beside it."""
    configure(spark)
    at = str(tmp_path_factory.mktemp("sf"))
    frame = spark.createDataFrame([(d, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"s{i % 2}", len(t or "")) for i, (d, t) in enumerate(ROWS)], SCHEMA)
    for name in CLASHES:
        frame = frame.withColumn(name, F.lit(1))
    frame.repartition(5).write.parquet(f"{at}/documents.parquet")
    labels = [(d, 1, int("x9" in (t or ""))) for d, t in ROWS] + [(None, 1, 1), (3, None, None), (12345, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("none"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def ordered(found):
    return sorted((tuple(r) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables_give_no_rows(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).collect() == []


def test_exact_dedup(spark, docs):
    assert ordered(queries.op1_exact_dedup(spark, docs).collect()) == ordered(plain.exact(ROWS))


def test_index_takes_and_gives_back(spark, docs):
    frame = spark.read.parquet(f"{docs}/documents.parquet").where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    some, others = frame.where("doc_id % 3 <> 0"), frame.where("doc_id % 3 = 0")
    index = exact_dedup.build(some, each=8)
    before = ordered(index.entries.collect())
    grown = index.insert(exact_dedup.members(others))
    pairs = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    assert ordered(exact_dedup.verdicts(grown).collect()) == ordered(plain.exact(pairs))
    back = grown.delete(others.select("doc_id"))
    assert ordered(back.entries.collect()) == before
    assert ordered(exact_dedup.verdicts(back).collect()) == ordered(plain.exact([p for p in pairs if p[0] % 3]))


def test_line_dedup_and_taking_back(spark, docs):
    assert ordered(queries.op9_line_dedup(spark, docs).collect()) == ordered(plain.lines(ROWS))
    frame = spark.read.parquet(f"{docs}/documents.parquet").where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    some, others = frame.where("doc_id % 2 = 1"), frame.where("doc_id % 2 = 0")
    index = line_dedup.build(some)
    back = index.insert(line_dedup.members(others)).delete(others.select("doc_id"))
    assert ordered(back.entries.collect()) == ordered(index.entries.collect())
    cut = line_dedup.apply(some.select("doc_id", "text"), line_dedup.dropped_keys(back))
    pairs = [(r.doc_id, r.text) for r in some.select("doc_id", "text").collect()]
    assert ordered((r.doc_id, r.text or "") for r in cut.collect()) == ordered(plain.lines(pairs, cut=True))


def test_toxicity(spark, docs):
    found = queries.op2_toxicity(spark, docs).collect()
    assert len(found) == len(ROWS)
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    frame = spark.read.parquet(f"{docs}/documents.parquet")
    model = toxicity.train(frame, spark.read.parquet(f"{docs}/labels.parquet").where(~toxicity.held_out()))
    kept = toxicity.keep_clean(frame, model)
    assert kept.columns == frame.columns
    assert ordered(kept.select("doc_id").collect()) == ordered((r.doc_id,) for r in found if r.score < 0.3)


def test_toxicity_without_labels_scores_all_alike(spark, docs):
    frame = spark.read.parquet(f"{docs}/documents.parquet").where("length(text) < 100")
    model = toxicity.train(frame, spark.createDataFrame([], "doc_id long, toxic int"))
    assert not model.weights.any()


def test_token_counts(spark, docs):
    library = Tokenizer.from_file(queries.BYTE_TOKENIZER)
    sizes = np.array([len(library.encode(t or "", add_special_tokens=False).ids) for _, t in ROWS])
    sums = queries.op3_token_counts(spark, docs).cache()
    for r in sums.collect():
        at = r.context_limit
        assert (r.n_docs, r.docs_over) == ((sizes == at).sum(), (sizes > at).sum())
        assert (r.tokens_upto, r.tokens_over, r.truncated_total) == (sizes[sizes <= at].sum(), sizes[sizes > at].sum(), np.minimum(sizes, at).sum())
        assert r.share_fitting == pytest.approx((sizes <= at).mean())
    for got in token_counts.at_limits(sums, [0, 1, 77, 10_000_000]):
        assert got["truncated_total"] == np.minimum(sizes, got["limit"]).sum() and got["docs_over"] == (sizes > got["limit"]).sum()
    assert token_counts.quantiles(sums, [0.5, 1.0]) == [np.sort(sizes)[-(-len(sizes) // 2) - 1], sizes.max()]


def test_sharding(spark, docs):
    table = sharding.fill()
    found = queries.op4_sharding(spark, docs).collect()
    assert len(found) == len(ROWS)
    for r in found:
        assert r.shard == table[r.slot] and r.shard_name == sharding.SHARDS[r.shard]
    assert len({r.slot for r in found if r.doc_id == 10}) == 1 and len({r.slot for r in found if r.doc_id is None}) == 1


def test_pii(spark, docs):
    texts = defaultdict(list)
    for d, t in ROWS:
        texts[d].append(t)
    for r in queries.op5_pii(spark, docs).collect():
        options = [plain.base_spans(t) for t in texts[r.doc_id]]
        joined = [",".join(f"{k}:{s}:{e}" for k, s, e in b) for b in options]
        at = [plain.sha(j) for j in joined].index(r.base_sha256)
        counts = [sum(k == kind for k, _, _ in options[at]) for kind in plain.PATTERNS]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        spans = [s.split(":") for s in r.spans.split(",") if s]
        assert set(filter(None, joined[at].split(","))) <= {":".join(s) for s in spans}
        order = [(pii.KINDS.index(k), int(s)) for k, s, _ in spans]
        assert order == sorted(order)


def test_pii_adds_and_redacts(spark):
    model = pii.Model([(1.0, (16, 0.5, -2.0, 2.0))], {"phone": 0.5, "secret": 0.5, "email": float("inf")})  # any with a digit
    frame = spark.createDataFrame([(1, "call (212) 555-0123 or a@b.co, token = abcdef123456", 7), (2, None, 7), (3, "no digits", 7)], "doc_id long, text string, base int")
    got = {r.doc_id: r for r in pii.find(frame, model).collect()}
    assert [(s.kind, s.start, s.end) for s in got[1].spans] == [("email", 23, 29), ("phone", 5, 19), ("secret", 31, 51)]
    assert [s.kind for s in got[1].base] == ["email"] and got[2].spans == [] and got[3].spans == []
    red = {r.doc_id: r.text for r in pii.redact(frame, model).collect()}
    assert red == {1: "call [phone] or [email], [secret]", 2: None, 3: "no digits"}
    assert pii.redact(frame, model).columns == frame.columns


def test_pii_keeps_rare_kinds(spark):
    """Kinds that bare tokens outnumber by a thousand to one still get a threshold."""
    rows = [(i, " ".join(f"r{i}x{j:04d}q" for j in range(400))) for i in range(20)]
    rows += [(100 + i, f"call +1 212 555 01{i}3 now") for i in range(8)]
    rows += [(200 + i, f"host 10.0.0.{i} and 300.1.1.{i} end") for i in range(8)]
    rows += [(300, "call (212) 555-0123 today"), (301, "call +1 212 555 0199, from 10.9.8.7")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    model = pii.train(frame, sample=200)
    assert all(model.thresholds[k] < 1 for k in ("phone", "ip"))
    got = {r.doc_id: [s.kind for s in r.spans] for r in pii.find(frame, model).collect()}
    assert got[300] == ["phone"] and got[301] == ["ip", "phone"] and got[0] == []
    some = pii.sampled(pii.labelled(frame), 200).groupBy("kind", "label").agg(F.count("*").alias("n"), F.sum(F.col("apart").cast("int")).alias("apart"))
    assert {(r.kind, r.label): (r.n, r.apart) for r in some.collect()} == {
        ("phone", 1.0): (9, 3), ("ip", 1.0): (9, 3), ("ip", 0.0): (8, 2), ("secret", 0.0): (20, 5)}


def test_bpe_round_trip(spark, docs):
    library = Tokenizer.from_file(queries.BYTE_TOKENIZER)
    want = []
    for d, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        digest = plain.hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((d, len(ids), digest, plain.sha(library.decode(ids, skip_special_tokens=False))))
    assert ordered(queries.op6_bpe(spark, docs).collect()) == ordered(want)


def test_encoding_and_decoding_apart(spark, docs):
    frame = spark.read.parquet(f"{docs}/documents.parquet")
    name = lexicon.build(frame, queries.BYTE_TOKENIZER, size=8)
    apart = lexicon.decode(lexicon.encode(frame, queries.BYTE_TOKENIZER, name), queries.BYTE_TOKENIZER)
    assert sorted(r.text for r in apart.collect()) == sorted(t or "" for _, t in ROWS)
    assert ordered(apart.collect()) == ordered(lexicon.round_trip(frame, queries.BYTE_TOKENIZER, name).collect())


def test_lexicon_counts_all_words(spark, docs):
    plain_rows = [(d, t) for d, t in ROWS if lexicon.Codec.plain(t or "")]  # other pieces never ask the lexicon
    frame = spark.createDataFrame(plain_rows, "doc_id long, text string")
    counted = {r.word: r.n for r in lexicon.count_words(frame, queries.BYTE_TOKENIZER, held=3).collect()}
    words = [w for _, t in plain_rows for w, _ in Tokenizer.from_file(queries.BYTE_TOKENIZER).pre_tokenizer.pre_tokenize_str(t or "")]
    assert counted["ing"] == words.count("ing") and counted[" ing"] == words.count("Ġing")


def test_near_dup(spark, docs):
    assert ordered(queries.op7_near_dup(spark, docs).collect()) == ordered(plain.near(ROWS))


def test_large_clusters_meet_in_blocks(spark, docs):
    frame = spark.read.parquet(f"{docs}/documents.parquet").where("doc_id IS NOT NULL")
    measured, frequent = near_dup.measured(frame), near_dup.frequent_shingles(frame, 10)
    whole = near_dup.components(near_dup.links(frame, measured, frequent))
    parts = near_dup.components(near_dup.links(frame, measured, frequent, block=3))
    assert ordered(parts.collect()) == ordered(whole.collect())


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 501), (700, 700)] + [(900, i) for i in range(901, 950)]
    got = near_dup.components(spark.createDataFrame(chain, "a long, b long").repartition(4)).collect()
    assert {r.node: r.root for r in got} == {i: 0 for i in range(1, 201)} | {501: 500} | {i: 900 for i in range(901, 950)}


def test_packing(spark, docs):
    library = Tokenizer.from_file(queries.WORD_TOKENIZER)
    want = sorted(np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for _, t in ROWS)
    frame = spark.read.parquet(f"{docs}/documents.parquet").coalesce(1).withColumn("doc_id", F.monotonically_increasing_id())
    pieces = packing.pack(frame, queries.WORD_TOKENIZER, block_tokens=5000).toPandas()
    pieces["size"] = pieces.ids.map(len)
    assert (pieces["size"] == 4 * pieces.length).all() and pieces.length.max() <= 4096
    made = [b"".join(g.sort_values("start").ids) for _, g in pieces.groupby("doc_id")]
    assert sorted(made) == want
    assert [n // 4 for n in map(len, made)] == pieces.groupby("doc_id").doc_tokens.first().tolist()
    for _, g in pieces.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]]
        total = int(g.length.sum())
        assert total <= 4096 and total & (total - 1) == 0
    digests = queries.op8_packing(spark, docs).toPandas()
    assert digests.length.sum() == sum(map(len, want)) // 4


def test_quality(spark, docs):
    found = queries.op10_quality(spark, docs).drop("n_boilerplate_words").collect()
    assert ordered(found) == ordered(plain.quality(ROWS))


def test_frequent_lines_deplete(spark):
    body = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    notice = " ".join(f"n{j}" for j in range(55))
    rows = [(i, f"{notice}\n{body(i)}", "h") for i in range(20)] + [(50 + i, f"{notice}\nshort {i}", "h") for i in range(10)]
    rows += [(100 + i, f"{body(7)}\ncopy", "h") for i in range(40)] + [(200, f"{notice}\nshort", "other")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in quality.judge(frame, min_docs=10).collect()}
    assert all(got[i].kept for i in range(20)) and not any(got[50 + i].kept for i in range(10))
    assert all(got[100 + i].kept for i in range(40))  # copies of one text are one document
    assert got[200].kept and not got[50].base_failed and got[50].n_boilerplate_words == 55


def test_numbers_are_never_added_as_secrets(spark):
    """What fails the card check is no secret; what the trees add holds letters, or is a phone or a card."""
    at = "/root/testdata/sf0.1"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "text").collect()}
    added = Counter()
    for r in queries.op5_pii(spark, at).select("doc_id", "spans").collect():
        for span in filter(None, r.spans.split(",")):
            kind, start, end = span.split(":")
            if kind == "secret":
                added["secret"] += 1
                assert any(c.isalpha() for c in texts[r.doc_id][int(start) : int(end)]), (r.doc_id, span)
    assert added["secret"] > 100


def test_verdicts_where_rows_cross_the_limit(spark):
    """Against counting every line of every host in one dictionary."""
    rng = random.Random(8)
    notices = [f"Notice {i} " + " ".join(f"n{i}x{j}" for j in range(rng.randint(3, 60))) for i in range(6)]
    rows = []
    for i in range(260):
        own = " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randint(0, 90)))
        lines = [own, *(n if rng.random() < 0.5 else n.upper() + " " for n in notices if rng.random() < 0.3)]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), rng.choice(["a", "a", "b", None])))
    rows += [(300 + i, rows[0][1], rows[0][2]) for i in range(80)]  # copies are one document
    held, seen = defaultdict(set), [(h, t, [plain.key(x) for x in t.split("\n")]) for _, t, h in rows]
    for host, text, keys in seen:
        for key in keys:
            held[host, key].add(text)
    want = {}
    for (doc, text, host), (_, _, keys) in zip(rows, seen, strict=True):
        n, left = len(text.split()), sum(len(x.split()) for x, k in zip(text.split("\n"), keys, strict=True) if len(held[host, k]) <= 20)
        want[doc] = (n - left, n >= 50 and left >= 50 and left >= 0.5 * n)
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = quality.judge(frame, min_docs=20).collect()
    assert {r.doc_id: (r.n_boilerplate_words, r.kept) for r in found} == want
    assert any(not r.base_failed and not r.kept for r in found) and any(r.kept and r.n_boilerplate_words for r in found)


def test_quality_acts_on_the_given_documents(spark):
    found = queries.op10_quality(spark, "/root/testdata/sf0.1")
    assert found.where("n_boilerplate_words > 0").count() > 0 and found.where("kept = base_failed AND NOT base_failed").count() > 0


def test_frequent_lines_are_cut_from_the_texts(spark):
    rows = [(i, f" A Notice \nw{i} own\n\nlast" if i % 2 else f"w{i} own\na notice\n\nlast {i}", "h", i) for i in range(30)]
    rows += [(40, "a notice\nrest", "other", 0), (41, None, "h", 0), (42, "A NOTICE", "h", 0), (43, "a notice\nrest", None, 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, more int")
    got = {r.doc_id: r for r in quality.without_boilerplate(frame, min_docs=20).collect()}
    assert len(got) == len(rows) and all(got[d].source == h and got[d].more == m for d, _, h, m in rows)
    assert [got[i].text for i in range(2)] == ["w0 own\n\nlast 0", "w1 own\n\nlast"]
    assert [got[i].text for i in (40, 41, 42, 43)] == ["a notice\nrest", None, "", "a notice\nrest"]
    judged = {r.doc_id: r for r in quality.judge(frame, min_docs=20).collect()}
    assert all(judged[d].n_words - judged[d].n_boilerplate_words == len((got[d].text or "").split()) for d in got)


def test_limit_does_not_rise_with_the_host(spark):
    rows = [(i, f"a notice\nw{i}" if i % 9 == 0 else f"w{i}", "h") for i in range(900)]  # a ninth of the host
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r.text for r in quality.without_boilerplate(frame).collect()} == {f"w{i}" for i in range(900)}


def test_repeated_lines_of_the_given_documents_fall(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    keyed = {}
    for r in docs.collect():
        for line in {x.strip().lower() for x in (r.text or "").split("\n")} - {""}:
            keyed.setdefault((r.source, line), set()).add(r.text)
    frequent = {k for k, held in keyed.items() if len(held) > 50}
    assert frequent
    left = quality.without_boilerplate(docs).collect()
    assert len(left) == docs.count()
    assert not any((r.source, x.strip().lower()) in frequent for r in left for x in (r.text or "").split("\n"))


def test_stages_of_the_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    frame = spark.read.parquet(f"{docs}/documents.parquet")
    columns = frame.columns
    seen = {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
        stage(spark, frame, docs).write.parquet(f"{tmp_path}/{i}")
        frame = spark.read.parquet(f"{tmp_path}/{i}")
        seen[name] = (before, frame)
        if name != "packing":
            assert frame.columns == columns
            assert frame.where("n_chars <> length(text)").count() == 0
    before, after = seen["line_dedup"]
    assert ordered((r.doc_id, r.text or "") for r in after.collect()) == ordered(plain.lines(before, cut=True))
    before, after = seen["near_duplicates"]
    keep = {d for d, _, c in plain.near(before) if d == c}
    assert ordered(after.select("doc_id").collect()) == ordered((d,) for d, _ in before if d in keep)
    before, after = seen["pii"]
    left = after.select("doc_id", "text").collect()
    assert len(left) == len(before) and not any(plain.base_spans(r.text) for r in left)
    before, after = seen["packing"]
    ends = after.groupBy("doc_id").agg(F.sum("length").alias("n")).toPandas()
    library = Tokenizer.from_file(queries.WORD_TOKENIZER)
    total = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in before)
    assert ends.n.sum() == total
