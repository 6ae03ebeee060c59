"""Cases in which an operator once did less than its whole job."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chalkline.llm import decontaminate, katz, katz_ngrams, ngram_join, source_mix, token_rollup
from chalkline.llm.queries import QUERIES
from chalkline.llm.twins import TWINS
from compare import difference
from test_queries_llm import views

WORD = re.compile(r"[^ \t-\r]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def katz_by_counting(rows, train):
    """Plain recursion over triples, pairs and words: the score of every document."""
    lines = {r["doc_id"]: ["<s>"] + WORD.findall(lowered(r["text"])) + ["</s>"] for r in rows}
    counts = [collections.Counter() for _ in range(4)]
    for doc in train:
        line = lines[doc]
        for n in (1, 2, 3):
            counts[n].update(tuple(line[k:k + n]) for k in range(n == 1, len(line) - n + 1))
    ratios = [None] + [katz.good_turing([sum(c == k for c in counts[n].values()) for k in range(1, 7)]) for n in (1, 2, 3)]
    cut = lambda n, c: c * (ratios[n][c] if c <= 5 else 1.0)
    total = sum(counts[1].values())
    unknown = 1 - sum(cut(1, c) for c in counts[1].values()) / (total + 1)
    after = collections.defaultdict(dict)
    for n in (2, 3):
        for gram, c in counts[n].items():
            after[gram[:-1]][gram[-1]] = c

    weights = {}

    def weight(history):
        """(factor, backoff weight)."""
        if history not in weights:
            seen = after[history]
            n = len(history) + 1
            occurrences = sum(seen.values())
            mass, reserve = sum(cut(n, c) for c in seen.values()) / occurrences, 1 / (occurrences + 1)
            factor = (1 - reserve) / mass if 1 - mass < reserve else 1
            weights[history] = factor / occurrences, (1 - factor * mass) / (1 - sum(probability(history[1:] + (w,)) for w in seen))
        return weights[history]

    def probability(gram):
        n, history = len(gram), gram[:-1]
        if n == 1:
            return cut(1, counts[1][gram]) / (total + 1) if gram in counts[1] else unknown
        if history not in after:
            return probability(gram[1:])
        factor, unseen = weight(history)
        return factor * cut(n, counts[n][gram]) if gram in counts[n] else unseen * probability(gram[1:])

    vocabulary = [w for (w,) in counts[1]] + ["<never>"]
    for history in [("<s>",), *list(counts[2])[:3]]:
        if history[-1] != "</s>":
            assert sum(probability(history + (w,)) for w in vocabulary) == pytest.approx(1)
    return {doc: sum(math.log10(probability(tuple(line[max(k - 2, 0):k + 1]))) for k in range(1, len(line))) for doc, line in lines.items()}


def test_katz_tells_rare_words_and_longer_histories_apart(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = documents.select("doc_id", "text").collect()
    scores = katz_by_counting(rows, [r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 10])
    for r in QUERIES["op1_katz"](spark, "/root/testdata/sf0.001").collect():
        assert r["score"] == pytest.approx(scores[r["doc_id"]])


def test_katz_pairs_of_rare_words(spark):
    texts = spark.createDataFrame([("the cat sat", ), ("a dog ran", ), ("the cat ran", )], "text string")
    probe = spark.createDataFrame([(1, "the cat"), (2, "the dog"), (3, "a dog ran"), (4, "the dog ran")], "doc_id long, text string")
    scores = {r["doc_id"]: r["score"] for r in katz_ngrams.score(probe, katz_ngrams.train(texts)).collect()}
    assert scores[1] > scores[2] and scores[3] > scores[4]


def links_by_counting(texts, percent=80):
    sets = {}
    for i, text in texts.items():
        tokens = WORD.findall(lowered(text))
        sets[i] = {tuple(tokens[k:k + 5]) for k in range(max(len(tokens) - 4, 1))} if tokens else set()
    return {i: sum(
        j != i and bool(own) and bool(sets[j]) and 100 * len(own & sets[j]) >= percent * len(own | sets[j]) for j in sets
    ) for i, own in sets.items()}


@pytest.mark.parametrize("block,sizes", [(64, (1, 60)), (3, (1, 60)), (1, (30, 60))])
def test_join_gives_all_links_of_a_component(spark, monkeypatch, block, sizes):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", block)
    rng = np.random.default_rng(block)
    texts = {}
    for _ in range(6):
        copy = [str(rng.integers(40)) for _ in range(rng.integers(*sizes))]
        for _ in range(9):
            texts[len(texts)] = " ".join(copy)
            copy = list(copy)
            for _ in range(rng.integers(0, 2)):
                copy[rng.integers(len(copy))] = str(rng.integers(40))  # a chain: its ends may not link
    table = spark.createDataFrame([*texts.items(), (900, None), (901, " ")], "doc_id long, text string")
    join = ngram_join.ngram_join(table)
    assert join.links.select("a", "b").distinct().count() == join.links.count()
    found = {r["doc_id"]: r["n_links"] for r in ngram_join.links_by_document(join).collect()}
    assert found == {**links_by_counting(texts), 900: 0, 901: 0}


def test_links_of_given_documents(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    found = {r["doc_id"]: r["n_links"] for r in QUERIES["op5_ngram_links"](spark, "/root/testdata/sf0.001").collect()}
    assert found == links_by_counting({r["doc_id"]: r["text"] for r in documents.collect()})


def test_windows_of_an_item_without_id(spark):
    benchmark = spark.createDataFrame([(None, "red green blue"), (1, "green blue grey"), (2, "one two")], "item_id long, text string")
    texts = [(1, "a red green blue b"), (2, "red green blue grey"), (3, "red green"), (None, None)]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    for size in (decontaminate.PATTERN_BYTES, 60):
        rows = decontaminate.find_contamination(table, benchmark, pattern_bytes=size).collect()
        found = {r["doc_id"]: (r["hit_words"], r["items"], r["spans"]) for r in rows}
        assert found == {1: ([1, 2, 3], [], [[2, 16]]), 2: ([0, 1, 2, 3], ["1"], [[0, 19]]), 3: ([], [], []), None: ([], [], [])}
    assert sorted(str(r["doc_id"]) for r in decontaminate.drop_contaminated(table, benchmark).collect()) == ["3", "None"]


def test_rollup_counts_every_row(spark, odd_tables):
    assert difference(QUERIES["op2_token_rollup"](spark, odd_tables), views(odd_tables), TWINS["op2_token_rollup"]) is None


def test_copies_are_counted_over_batches(spark, tmp_path):
    """Against a plain multiset: equal rows come in several batches, some go, the rest is revised, and batches are compacted."""
    ledger = token_rollup.Ledger(spark, str(tmp_path / "ledger"))
    equal, other = (None, "one two three", "en", "a"), (5, "one", None, None)
    documents = lambda *rows: spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    counts = lambda op, *rows: token_rollup.word_counts(documents(*rows), "words-1", op)
    totals = lambda: {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in ledger.totals().collect()}
    ledger.apply("1", counts("insert", equal, equal, other))
    ledger.apply("2", counts("insert", equal))
    ledger.apply("2", counts("insert", equal))
    assert totals() == {("a", "en"): (3, 9), (None, None): (1, 1)}
    ledger.apply("3", counts("delete", equal, (6, "not there", "en", "a")))
    assert totals() == {("a", "en"): (2, 6), (None, None): (1, 1)}
    ledger.compact()
    assert totals() == {("a", "en"): (2, 6), (None, None): (1, 1)} and not ledger.apply("1", counts("insert", equal))
    shorter = documents((None, "one", "en", "a")).withColumn("doc_key", F.lit(None).cast("long"))
    key = documents(equal).select(token_rollup.document_key().alias("k")).first()["k"]
    ledger.apply("4", token_rollup.word_counts(shorter, "words-1", "revise", F.lit(key)))
    assert totals() == {("a", "en"): (2, 2), (None, None): (1, 1)}
    ledger.compact()
    ledger.apply("5", counts("delete", other, other, other).unionByName(
        token_rollup.word_counts(shorter, "words-1", "delete", F.lit(key)).withColumn("n_tokens", F.lit(99).cast("long"))))
    assert totals() == {("a", "en"): (1, 1)} and ledger.committed() == ["1", "2", "3", "4", "5"]
    assert [(r["each"], r["n_docs"]) for r in ledger.live().collect()] == [(1, 1)]


def test_a_batch_reads_the_ranges_of_its_documents(spark, tmp_path):
    ledger = token_rollup.Ledger(spark, str(tmp_path / "ledger"))
    rows = spark.range(400).selectExpr("id AS doc_id", "'a b' AS text", "'en' AS lang", "'s' AS source")
    ledger.apply("1", token_rollup.word_counts(rows, "words-1"))
    some = ledger.live_of([3])
    assert "part" in some._jdf.queryExecution().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert 0 < some.count() < 40
    ledger.apply("2", token_rollup.word_counts(rows.where("doc_id < 10"), "words-1", "delete"))
    assert [(r["n_docs"], r["n_tokens"]) for r in ledger.totals().collect()] == [(390, 780)]


def test_mix_of_overlapping_sources_is_applied(spark):
    rows = [(i, f"w{i} " * (i % 7 + 1), ["a"] if i % 3 == 0 else ["b", "a"] if i % 3 == 1 else ["b", "c", "a", "b"]) for i in range(300)]
    table = spark.createDataFrame([*rows, (900, "x y", None), (901, "x y", [])], "doc_id long, text string, belongs array<string>")
    mix = source_mix.plan_mix(table, F.col("belongs"))
    planned = {r["doc_id"]: r["copies"] for r in source_mix.mixed_rows(mix).collect() if r["copies"]}
    assert {tuple(rows[i][2]) for i in planned} == {("a",), ("b", "a"), ("b", "c", "a", "b")} and abs(
        sum(copies * (i % 7 + 1) for i, copies in planned.items()) - sum(mix.targets.values())
    ) <= 3 * 7
    for applied in (source_mix.apply_mix(table, mix), source_mix.apply_mix(table, mix, sources=F.col("belongs"))):
        assert collections.Counter(r["doc_id"] for r in applied.collect()) == planned


def test_mix_takes_no_texts_without_words(spark):
    rows = [(i, "w " * (i % 9), "ab"[i % 2]) for i in range(200)] + [(900 + i, None, "b") for i in range(20)] + [(None, " \n", "a")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mix = source_mix.plan_mix(table)
    applied = source_mix.apply_mix(table, mix)
    assert applied.count() and all((r["text"] or "").strip() for r in applied.collect())
    planned = {r["doc_id"]: r["copies"] for r in source_mix.mixed_rows(mix).collect() if r["copies"]}
    assert collections.Counter(r["doc_id"] for r in applied.collect()) == planned and max(planned.values()) <= 3


def plainly_mixed(rows):
    """{row number: copies} of single sources: the flow's words by source, then the seeded order walked row by row."""
    sizes, copies = collections.Counter(), {}
    for r in rows:
        sizes[r["source"]] += r["size"]
    targets = source_mix.target_words(dict(sizes))
    for name in sizes:
        own = sorted((r["cell"], r["pick"], n) for n, r in enumerate(rows) if r["source"] == name and r["size"])
        if not own:
            continue
        whole, left = divmod(round(targets[name]), sizes[name])
        for *_, n in own:
            size = rows[n]["size"]
            copies[n] = whole + (2 * left >= size)
            left = left - size if 2 * left >= size else -1
    return copies, targets


@pytest.mark.parametrize("equal", [0, 300])
def test_mix_against_a_walk(spark, equal):
    """Rows equal in id and text are taken singly, so that a source of little else still meets its target."""
    rng = np.random.default_rng(equal)
    rows = [(int(i), "w " * int(rng.integers(0, 9)), "abc"[int(rng.integers(3))], f"u{i}") for i in range(400)]
    rows += [(None, "x y z v", "c", f"u{i % 7}") for i in range(equal)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, url string")
    mix = source_mix.plan_mix(table)
    sized = source_mix.sized_rows(table, F.array("source")).withColumn("source", F.col("members")[0]).collect()
    plain, targets = plainly_mixed(sized)
    key = lambda r: (r["doc_id"], r["size"])
    wanted = collections.Counter((*key(sized[n]), c) for n, c in plain.items())
    found = collections.Counter((*key(r), r["copies"]) for r in source_mix.mixed_rows(mix).collect() if r["size"])
    assert found == wanted and max(c for *_, c in found) <= 3
    assert source_mix.mixed_rows(mix).count() == len(rows)
    words = collections.Counter()
    for r in source_mix.apply_mix(table, mix).collect():
        words[r["source"]] += len(r["text"].split())
    assert all(abs(words[name] - targets[name]) <= 5 for name in targets)


def test_decontamination_twin_knows_items_without_id(spark, tmp_path):
    """An item without an id hits words but is not named, in the operator and in its twin."""
    spark.createDataFrame([(1, "a Line one, is b"), (2, "one two"), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, "LINE one is"), (7, "one two")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = QUERIES["op8_decontaminate"](spark, str(tmp_path))
    assert {(r["doc_id"], r["n_hit"], r["n_items"]) for r in df.collect()} == {(1, 3, 0), (2, 2, 1), (3, 0, 0)}
    assert difference(df, views(str(tmp_path), ("documents", "benchmark")), TWINS["op8_decontaminate"]) is None


def test_katz_keeps_no_table_of_pairs_or_triples(spark, tmp_path, monkeypatch):
    """Counted n-grams once lay in tables beside the shuffles that made them, more than the disk held."""
    monkeypatch.setattr(katz_ngrams, "scratch_path", lambda spark, purpose: f"{tmp_path}/{purpose}")
    rng = np.random.default_rng(5)
    texts = [(i, " ".join(map(str, rng.integers(0, 5000, 400)))) for i in range(60)] + [(60, None), (None, "1 2 3"), (3, "")]
    table = spark.createDataFrame(texts, "doc_id long, text string").coalesce(2)
    katz_ngrams.held_out_scores(table).collect()
    for path in tmp_path.glob("*/*"):
        kept = spark.read.parquet(str(path))
        assert path.name == "counts" or not kept.where(F.col("kind") == katz_ngrams._COUNTS).count()
        if path.name == "counts":
            assert not kept.where("n > 1 AND octet_length(x) > 0").count()


def test_katz_rounds_change_no_score(spark, monkeypatch):
    rng = np.random.default_rng(6)
    texts = [(i % 90, " ".join(map(str, rng.zipf(1.4, 60) % 300))) for i in range(120)] + [(7, None), (None, "1 2 1 2 1"), (8, " ")]
    table = spark.createDataFrame(texts, "doc_id long, text string").coalesce(3)

    def scores():
        return sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in katz_ngrams.held_out_scores(table).collect())

    whole = scores()
    monkeypatch.setattr(katz_ngrams, "TRIPLE_SHARES", (0.1, 0.3, 0.6))
    assert scores() == whole
