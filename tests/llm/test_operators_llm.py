"""The operators against plain versions of their own rules."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chalkline.llm import (
    byte_rnn, components, decontaminate, hash_ring, katz, ngram_join, quality_rules, rule_ensemble, source_mix,
    token_rollup, toxicity_fm, words,
)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^ \t-\r]+")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def test_words_of_slices():
    texts = ["One two\n\x0bTHREE", None, "", "  é b  c", "x" * 700_000 + " end", "two"]
    column = pa.chunked_array([pa.array(texts[:2]), pa.array(texts[2:])])
    found = {}
    for first, data, offsets in words.slices(column):
        hashes, at = words.hashed_words(data, offsets)
        for i in range(len(offsets) - 1):
            found[first + i] = hashes[at[i]:at[i + 1]].tolist()
    assert [found[i] for i in range(len(texts))] == [[words.hash_text(lowered(w)) for w in WORD.findall(t or "")] for t in texts]
    x = np.arange(1000, dtype=np.uint64) * np.uint64(0x123456789ABCDEF)
    assert (words.unmixed(words.mixed(x)) == x).all()


def test_katz_against_counting(spark, documents):
    rows = documents.select("doc_id", "text").collect()
    train = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 10]
    tokens = {r["doc_id"]: WORD.findall(lowered(r["text"])) + ["</s>"] for r in rows}
    count = collections.Counter(t for r in train for t in tokens[r["doc_id"]])
    total, types = sum(count.values()), len(count)
    frequent = {w for w, c in count.items() if c >= max(2, katz.FREQUENT * total)}
    cls = {w: w if w in frequent or w == "</s>" else "<rare>" for d in tokens.values() for w in d}
    cls.update({"<s>": "<s>"})
    pairs, history = collections.Counter(), collections.Counter()
    for r in train:
        line = ["<s>"] + [cls[w] for w in tokens[r["doc_id"]]]
        pairs.update(zip(line, line[1:]))
        history.update(line[:-1])
    ratios = katz.good_turing([sum(c == k for c in pairs.values()) for k in range(1, 7)])
    rare = {w: c for w, c in count.items() if cls[w] == "<rare>"}
    rare_ratios = katz.good_turing([sum(c == k for c in rare.values()) for k in range(1, 7)])
    cut = lambda c, by: c * (by[c] if c <= 5 else 1.0)
    classes = collections.Counter()
    for w, c in count.items():
        classes[cls[w]] += c
    share = {k: (classes[k] + (k in ("<rare>", "</s>"))) / (total + 2) for k in {*classes, "<rare>", "</s>"}}
    probability, after = {}, collections.defaultdict(dict)
    for (h, w), c in pairs.items():
        after[h][w] = cut(c, ratios) / history[h]
    for h in history:
        seen = after[h]
        mass, lower = sum(seen.values()), sum(share[w] for w in seen)
        factor = 1 / mass if lower > 1 - 1e-9 else (1 - 1 / (history[h] + 1)) / mass if 1 - mass < 1 / (history[h] + 1) else 1
        weight = 0 if lower > 1 - 1e-9 else (1 - factor * mass) / (1 - lower)
        probability[h] = (factor, weight)
        unseen = sum(share[w] for w in share if w not in seen) if len(seen) > 50 else 1 - lower
        assert factor * mass + weight * unseen == pytest.approx(1)
    rare_total = sum(rare.values()) + 1
    within = {w: cut(c, rare_ratios) / rare_total for w, c in rare.items()}
    unknown = 1 - sum(within.values())

    def scored(doc):
        line, result = ["<s>"] + tokens[doc], 0.0
        for h, w in zip(line, line[1:]):
            factor, weight = probability.get(cls[h], (1, 1))
            seen = after[cls[h]]
            p = factor * seen[cls[w]] if cls[w] in seen else weight * share[cls[w]]
            result += math.log10(p * (within.get(w, unknown) if cls[w] == "<rare>" else 1))
        return result

    for r in katz.held_out_scores(documents).collect():
        own = tokens[r["doc_id"]]
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (types + 1))) for w in own)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(count[w] > 0 for w in own), total)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(scored(r["doc_id"]))


def test_ledger_commits_once(spark, tmp_path):
    ledger = token_rollup.Ledger(spark, str(tmp_path / "ledger"))
    schema = "op string, doc_id long, source string, lang string, tokenizer string, n_tokens long"
    first = spark.createDataFrame([
        ("insert", 1, "a", "en", "t", 10), ("insert", 1, "a", "en", "t", 10), ("insert", 2, "a", None, "t", 5), ("insert", None, None, None, "t", 3),
    ], schema)
    second = spark.createDataFrame([
        ("revise", 1, "b", "en", "t", 7), ("delete", 2, None, None, "t", None), ("delete", 9, "a", "en", "t", 1),
    ], schema)
    assert ledger.totals().collect() == []
    assert ledger.apply("1", first) and not ledger.apply("1", first)
    found = {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in ledger.totals().collect()}
    assert found == {("a", "en"): (1, 10), ("a", None): (1, 5), (None, None): (1, 3)}
    spark.range(3).write.parquet(f"{ledger.root}/entries/2")  # a batch that failed before its commit
    assert ledger.apply("2", second) and not ledger.apply("2", first)
    assert ledger.apply("3", second.where("false"))
    found = {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in ledger.totals().collect()}
    assert found == {("b", "en"): (1, 7), (None, None): (1, 3)}


def test_bpe_counts(spark):
    import base64

    import public_tokenizers as P
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    rows = [(1, "Hello world, hello <|endoftext|>", "en", "a"), (2, None, "en", "a"), (3, "", None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    counted = {r["doc_id"]: r["n_tokens"] for r in token_rollup.bpe_counts(table, path, P.PATTERN, "bpe-50k").collect()}
    assert counted == {i: len(plain.encode_ordinary(t or "")) for i, t, _, _ in rows}


def test_rules_fit_and_compile(spark):
    rng = np.random.default_rng(1)
    x = rng.random((2000, len(rule_ensemble.STATISTICS)))
    y = ((x[:, 3] > 0.6) & (x[:, 8] <= 0.5)).astype(float)
    model = rule_ensemble.fit(x, y)
    assert 0 < len(model[1]) < 80
    table = spark.createDataFrame(x.tolist(), ", ".join(f"{n} double" for n in rule_ensemble.STATISTICS))
    scores = np.array([r[0] for r in table.select(rule_ensemble.compile_score(model)).collect()])
    plain = 1 / (1 + np.exp(-(model[0] + sum(w * rule_ensemble.holds(rule, x) for rule, w in model[1]))))
    assert np.allclose(scores, plain) and ((scores > 0.5) == (y > 0)).mean() > 0.98


def test_classifiers_on_held_out_documents(spark, documents):
    # The smallest tables mark too few documents to learn from.
    folder = "/root/testdata/sf0.01"
    documents, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    for module, label in ((toxicity_fm, "toxic"), (rule_ensemble, "quality")):
        judged = module.judged(module.score(documents, module.train(documents, labels)))
        right = judged.where("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col(label)).cast("double")))
        assert right.first()[0] > 0.9


def test_factorization_machine_learns_pairs():
    rng = np.random.default_rng(0)
    n, vocabulary = 3000, 60
    x = rng.random((n, vocabulary)) < 0.1
    x[:, 0], x[:, 1] = rng.random(n) < 0.5, rng.random(n) < 0.5
    y = (x[:, 0] == x[:, 1]).astype(float)  # no weight of one term tells anything
    rows, terms = np.nonzero(x)
    model = toxicity_fm.fit(rows, terms.astype(np.uint32), y)
    assert {0, 1} <= set(model.terms.tolist())
    at = np.searchsorted(model.terms, terms)
    inside = model.terms[np.minimum(at, len(model.terms) - 1)] == terms
    assert ((model.margins(rows[inside], at[inside], n) > 0) == (y > 0)).mean() > 0.95


def test_margins_are_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    x, model = rng.random((40, 12)) < 0.4, toxicity_fm.Model(np.arange(12), 0.3, rng.normal(size=12), rng.normal(size=(12, 4)))
    for row, margin in zip(x, model.margins(*np.nonzero(x), 40)):
        held = np.flatnonzero(row)
        plain = model.bias + sum(model.weights[i] for i in held)
        for k, i in enumerate(held):
            for j in held[k + 1:]:
                plain += sum(model.vectors[i, f] * model.vectors[j, f] for f in range(4))
        assert margin == pytest.approx(plain)


def test_pairs_of_terms_that_are_neutral_alone(spark):
    """Two words decide together: each is as frequent in clean documents as in toxic ones."""
    rng = np.random.default_rng(5)
    texts, labels = [], []
    for i in range(4000):
        body = [f"filler{k}" for k in rng.zipf(1.3, 40) % 3000]
        group, insult = rng.random(2) < 0.5
        body += ["Wugglish"] * int(group) + ["GRONKY!"] * int(insult)
        rng.shuffle(body)
        texts.append((i, " ".join(body)))
        labels.append((i, int(group == insult)))
    documents = spark.createDataFrame(texts, "doc_id long, text string")
    model = toxicity_fm.train(documents, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = {r["doc_id"]: r for r in toxicity_fm.judged(toxicity_fm.score(documents, model)).collect()}
    held_out = [(found[i]["predicted"], y) for i, y in labels if found[i]["held_out"]]
    assert len(held_out) > 600 and sum(p == y for p, y in held_out) / len(held_out) > 0.95


def brute_components(texts, percent=80):
    sets = {}
    for i, text in texts.items():
        tokens = WORD.findall(lowered(text))
        sets[i] = {tuple(tokens[k:k + 5]) for k in range(max(len(tokens) - 4, 1))} if tokens else set()
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    names = sorted(texts)
    for n, a in enumerate(names):
        for b in names[n + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and sets[b]:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in texts}


@pytest.mark.parametrize("seed", [1, 2])
def test_join_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = {}
    for group in range(12):
        base = list(rng.choice(vocabulary, rng.integers(1, 60)))
        for _ in range(rng.integers(1, 9)):
            copy = list(base)
            for _ in range(rng.integers(0, 3)):
                copy[rng.integers(len(copy))] = str(rng.choice(vocabulary))
            texts[len(texts)] = " ".join(copy)
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = ngram_join.components_by_document(ngram_join.ngram_join(table)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == brute_components(texts)


def test_components_of_a_long_chain(spark):
    order = np.random.default_rng(3).permutation(200).tolist()
    links = spark.createDataFrame([*zip(order, order[1:]), (500, 501), (501, 500), (7, 7)], "a long, b long")
    labels = {r["id"]: r["label"] for r in components.connected_components(links).collect()}
    assert labels == {**dict.fromkeys(order, 0), 500: 500, 501: 500}


def test_ring_balance_and_movement(spark):
    table = spark.range(20_011).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    before, after = (hash_ring.assign_shards(table, shards) for shards in (10, 11))
    rows = before.collect()
    by_shard = collections.defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r["slot"])
    assert len(rows) == 20_011 and max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    # One shard of eleven is new; rows also move because quotas are exact. A modulus would move ten of eleven rows.
    assert 1 / 11 <= hash_ring.moved_share(before, after) < 0.45


def test_targets_and_flow():
    assert source_mix.target_words({"a": 10, "b": 100, None: 90}) == {"a": 30.0, "b": pytest.approx(340 / 3), None: pytest.approx(170 / 3)}
    assert source_mix.target_words({}) == {} and source_mix.target_words({"a": 0}) == {"a": 0.0}
    # "both" belongs to two sources: it fills the one whose own documents would have to repeat.
    flow = source_mix.route({"x": 100, "y": 10, "both": 50}, {"x": ["a"], "y": ["b"], "both": ["a", "b"]}, {"a": 100, "b": 60})
    assert flow["x", "a"] == 100 and flow["y", "b"] == 10 and flow["both", "b"] == 50 and flow["both", "a"] == 0
    # Second copies are taken everywhere before third ones.
    flow = source_mix.route({"x": 10, "y": 10}, {"x": ["a"], "y": ["a"]}, {"a": 40})
    assert flow == {("x", "a"): 20, ("y", "a"): 20}


def test_mix_meets_targets(spark, documents):
    mix = source_mix.plan_mix(documents)
    rows = source_mix.mixed_rows(mix).collect()
    largest = max(r["size"] for r in rows)
    for name, target in mix.targets.items():
        own = [r for r in rows if r["members"] == [name]]
        assert abs(sum(r["taken"] for r in own) - target) <= largest / 2 + 1
        assert mix.sizes[name] == sum(r["size"] for r in own)
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    again = source_mix.mixed_rows(source_mix.plan_mix(documents.repartition(7)))
    assert sorted(map(tuple, again.drop("members").collect())) == sorted((r["doc_id"], r["size"], r["copies"], r["taken"]) for r in rows)


def test_spans_and_blocks_of_patterns(spark):
    benchmark = spark.createDataFrame([(1, "Alpha beta, GAMMA"), (2, "beta gamma delta"), (3, "zeta " * 12)], "item_id long, text string")
    texts = [(1, "x alpha--BETA gamma delta é"), (2, "alphabeta gamma"), (3, "Zeta " * 11), (4, None)]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    one = decontaminate.find_contamination(table, benchmark).orderBy("doc_id").collect()
    many = decontaminate.find_contamination(table, benchmark, pattern_bytes=60).orderBy("doc_id").collect()
    assert [(r["hit_words"], r["items"]) for r in one] == [([1, 2, 3, 4], ["1", "2"]), ([], []), (list(range(11)), ["3"]), ([], [])]
    text = texts[0][1].encode()
    assert [text[a:b] for a, b in one[0]["spans"]] == [b"alpha--BETA gamma delta"]
    assert [(r["n_words"], r["hit_words"], r["items"]) for r in many] == [(r["n_words"], r["hit_words"], r["items"]) for r in one]


def test_gradients_of_the_network():
    rng = np.random.default_rng(5)
    network = byte_rnn.fit([], np.zeros(0, int), ["a", "b", "c"], hidden=3)
    network.weights = {k: v.astype(np.float64).astype(np.float32) for k, v in network.weights.items()}
    codes = rng.integers(97, 105, (7, 4)).astype(np.intp)
    valid = np.ones((7, 4), np.float32)
    valid[5:, 2] = 0
    targets = np.array([0, 1, 2, 1])
    _, grads = byte_rnn.gradients(network, codes, valid, targets)
    for name, at in (("out", (1, 4)), ("bias", (2,)), ("uf", (7, 1)), ("ub", (0, 2)), ("xf", (8, codes[3, 0])), ("xb", (4, codes[2, 1]))):
        kept, losses = network.weights[name][at], []
        for step in (1e-2, -1e-2):
            network.weights[name][at] = kept + step
            losses.append(byte_rnn.gradients(network, codes, valid, targets)[0])
        network.weights[name][at] = kept
        assert grads[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-2, abs=2e-3)


def test_language_of_held_out_documents(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    network = byte_rnn.train(documents)
    found = byte_rnn.judged(byte_rnn.identify(documents, network)).join(documents.select("doc_id", "lang"), "doc_id")
    assert found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.95
    assert len(byte_rnn.label_positions(network, "the ñ and é" * 20)) == len(("the ñ and é" * 20).encode())
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?")], "doc_id long, text string")
    assert {r["lang_pred"] for r in byte_rnn.identify(odd, network).collect()} == {"und"}


def test_quality_verdicts_keep_good_documents(spark):
    folder = "/root/testdata/sf0.01"
    verdicts = quality_rules.quality_verdicts(spark.read.parquet(f"{folder}/documents.parquet"))
    good = verdicts.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("quality = 1 AND NOT base_failed")
    assert good.agg(F.avg(F.col("kept").cast("double"))).first()[0] > 0.99
    plan = verdicts._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
