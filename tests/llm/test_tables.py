"""URL filters, toxicity, mixing, vector near-duplicates and the pipeline."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import duck
from lexipost.llm import mixing, queries, toxicity, url_filter, vector_dedup
from lexipost.llm.hnsw import Hnsw
from lexipost.llm.ordinal import fit_ordinal
from lexipost.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    got = queries.QUERIES[name](spark, SF)
    assert duck.differences(got, duck.connect(SF), ORACLE[name]) is None


URLS = [
    (1, "http://a.b.example.com/en/x/y?q#f"),
    (2, "https://EXAMPLE.com/en"),
    (3, None),
    (4, ""),
    (5, "no scheme.com/en/"),
    (6, "x://"),
    (7, "x://notexample.com/en/1"),
    (8, "x://www.example.com/en/"),
    (8, "x://www.example.com/en/"),
    (None, "http://u.net?://other.com/"),
    (10, "http://a.net/es/1#/"),
    (11, "http://" + "l." * 200 + "net/" + "d/" * 500),
    (12, "http://é.net/fr/\n"),
]


def brute_verdict(host, path, rules, default="allow"):
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (max(fits)[2], max(fits)[3]) if fits else (None, default)


@pytest.mark.parametrize("bound", [url_filter.BROADCAST_RULES, 0])
def test_urls_equal_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(url_filter, "BROADCAST_RULES", bound)  # 0: the shuffled join
    extra = [("example.com", "/en/x", "block"), ("example.com", "", "allow"), ("b.example.com", "/", "block")]
    rules = [*queries.URL_RULES, *extra]
    pages = spark.createDataFrame([(i, u, "r", "h") for i, u in URLS], "page_id bigint, url string, rule string, host string")
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("a.net", "/", None)], "host string, path string, verdict string")
    got = url_filter.judge_urls(pages, table).collect()
    assert Counter(r.page_id for r in got) == Counter(i for i, _ in URLS)
    for r in got:
        assert (r.rule, r.verdict) == brute_verdict(r.host, r.path, rules), r
    by_id = {r.page_id: r for r in got}
    assert (by_id[1].host, by_id[1].path) == ("a.b.example.com", "/en/x/y")
    assert (by_id[2].host, by_id[2].path) == ("example.com", "/en")
    assert (by_id[None].host, by_id[None].path) == ("u.net", "")
    assert {(by_id[i].host, by_id[i].path) for i in (3, 4, 5, 6)} == {("", "")}


def test_urls_without_rules_or_rows(spark):
    pages = spark.createDataFrame(URLS, "page_id bigint, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_filter.judge_urls(pages, none).collect()} == {"allow"}
    some = spark.createDataFrame(queries.URL_RULES, none.schema)
    assert url_filter.judge_urls(pages.filter("false"), some).count() == 0


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 4, 800)
    rows = [np.unique(np.append(rng.choice(40, g * 4, replace=False), 50 + rng.integers(0, 20, 6))) for g in grades]
    model = fit_ordinal(np.concatenate(rows), np.array([len(r) for r in rows]), grades, 70, 4)
    assert np.all(np.diff(model.thresholds) > 0)
    expected = model.expected(np.array([model.weights[r].sum() for r in rows]))
    assert np.corrcoef(expected, grades)[0, 1] > 0.9
    assert np.abs(model.weights[50:]).max() < np.abs(model.weights[:40]).min()


def test_ordinal_fit_without_documents():
    none = np.empty(0, np.int64)
    model = fit_ordinal(none, none, none, 3, 4)
    assert model.above(np.zeros(1)).max() < 0.01


def test_toxicity_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held_out = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(4)) == 0
    model = toxicity.fit_toxicity(docs, labels.filter(~held_out))
    judged = (
        toxicity.score_toxicity(docs, model)
        .withColumnRenamed("toxic", "found")
        .join(labels.filter(held_out).select("doc_id", "toxic"), "doc_id")
        .groupBy("toxic", "found")
        .count()
    )
    table = {(r.toxic, r.found): r["count"] for r in judged.collect()}
    hit, missed = table.get((1, True), 0), table.get((1, False), 0)
    wrong, right = table.get((0, True), 0), table[(0, False)]
    assert hit / (hit + missed) > 0.85  # of junk with one marked word some are missed
    assert wrong / (wrong + right) < 0.01


def test_toxicity_of_edges(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame([(1, 0), (5, 1), (5, 0), (None, 1), (99, 1), (2, None)], "doc_id bigint, toxic int")
    model = toxicity.fit_toxicity(edge_docs, labels)
    rows = toxicity.score_toxicity(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(r.kept != r.toxic for r in rows)
    none = toxicity.fit_toxicity(edge_docs, labels.filter("false"))
    assert toxicity.without_toxic(edge_docs, none).count() == edge_docs.count()
    assert toxicity.score_toxicity(empty_docs, model).count() == 0
    score = toxicity.Scorer({f: 1.0 for f in toxicity.word_features("idiot")})
    assert score("an IDIOT, idiot") == 2.0 and score(None) == score("") == 0


def test_repeated_documents_do_not_fill_the_sample(spark):
    words = [(i, f"common word{i % 7} " + ("awful" if i % 2 else "nice")) for i in range(40)]
    rows = words + [(0, words[0][1])] * 500 + [(1, "zz other text")] * 500
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, toxic int")
    fit = lambda r: toxicity.fit_toxicity(spark.createDataFrame(r, "doc_id bigint, text string"), labels, train_docs=40)
    model = fit(rows)
    # As if every key had one row, the one of the text with the least hash.
    texts = spark.createDataFrame(rows, "doc_id bigint, text string").groupBy("doc_id")
    once = texts.agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("t")).select("doc_id", "t.text")
    plain = fit([tuple(r) for r in once.collect()])
    assert model.weights == plain.weights and model.thresholds.tolist() == plain.thresholds.tolist()


def test_mixture_of_whole_table(spark, small_docs):
    block = 2_000
    rows = mixing.mix_sources(small_docs, block_chars=block).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in small_docs.select("doc_id").collect())
    texts = {r.doc_id: len(r.text) for r in small_docs.collect()}
    at = {}
    for r in sorted(rows, key=lambda r: (r.source, r.doc_id)):
        assert r.block == at.get(r.source, 0) // block
        at[r.source] = at.get(r.source, 0) + texts[r.doc_id]
    # Every slot takes one block, and blocks of a source come in order.
    slots = {(r.source, r.block): r.slot for r in rows}
    assert len(set(slots.values())) == len(slots)
    for (s, b), slot in slots.items():
        assert (s, b - 1) not in slots or slots[(s, b - 1)] < slot
    # While no source has run out, each is less than one block from its share.
    total = sum(n**0.5 for n in at.values())
    shares = {s: n**0.5 / total for s, n in at.items()}
    first_end = min(-(-n // block) / shares[s] for s, n in at.items())
    for r in rows:
        if r.slot < first_end - 1:
            assert abs(r.block - r.slot * shares[r.source]) < 1 + 1e-9


def test_mixture_of_edges(spark, edge_docs, empty_docs):
    rows = mixing.mix_sources(edge_docs, {"a": 3, "b": 1, "gone": 2, "none": 0}, block_chars=10).collect()
    assert len(rows) == edge_docs.count()
    last = max(r.slot for r in rows if r.source in ("a", "b"))
    assert all(r.slot > last and r.release is None for r in rows if r.source not in ("a", "b"))
    assert mixing.mix_sources(edge_docs).count() == edge_docs.count()
    assert mixing.mix_sources(empty_docs).count() == 0
    mixed = mixing.mixed(edge_docs, mixing.mix_sources(edge_docs, block_chars=10))
    assert mixed.columns == edge_docs.columns and mixed.count() == edge_docs.count()


@pytest.mark.parametrize(
    "sources",
    [
        {"a": (3_000, 0.12345), "b": (7_000, 0.87655)},
        {"big": (2_000, 0.5), **{f"s{i}": (4, 0.5 / 900) for i in range(900)}},
        {"a": (5_000, 1.0), "rare": (3, 1e-3), "b": (900, 0.61803), "c": (40, 0.3)},
        {"a": (50, 5), "b": (30, 3), "c": (2_000, 2)},
    ],
)
def test_slots_stay_within_a_block_of_real_weights(sources):
    order = list(mixing.scheduled([(s, n, w) for s, (n, w) in sources.items()]))
    assert [x[4] for x in order] == list(range(sum(n for n, _ in sources.values())))
    assert Counter(x[0] for x in order) == {s: n for s, (n, _) in sources.items()}
    taken = Counter()
    ideal = dict.fromkeys(sources, 0.0)
    for source, number, release, deadline, slot in order:
        assert release <= slot < deadline and number == taken[source]
        taken[source] += 1
        free = 1.0  # the ideal of one slot, dealt to those that have text left
        while free > 1e-12:
            live = {s: w for s, (n, w) in sources.items() if ideal[s] < n - 1e-9}
            if not live:
                break
            step = min([free / sum(live.values()), *((sources[s][0] - ideal[s]) / w for s, w in live.items())])
            for s, w in live.items():
                ideal[s] += step * w
            free -= step * sum(live.values())
        assert all(abs(taken[s] - ideal[s]) < 1 + 1e-6 for s in sources)


def test_mixture_meets_unrounded_weights(spark):
    """Weights that no frame of 1,000 holds: the deviation stays below a block."""
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("source"), F.lit("x").alias("text")
    )
    weights = {"a": 0.2504, "b": 0.7496}
    rows = mixing.mix_sources(docs, weights, block_chars=1).collect()
    assert sorted(r.slot for r in rows) == list(range(30_000))
    last = min(7_500 / 0.2504, 22_500 / 0.7496)
    assert all(abs(r.block - r.slot * weights[r.source]) < 1 + 1e-6 for r in rows if r.slot < last - 1)


def test_mixture_of_more_than_ten_thousand_sources(spark):
    docs = spark.range(24_200).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("site"), F.col("id") % 12_100).alias("source"), F.lit("xy").alias("text")
    )
    rows = mixing.mix_sources(docs, block_chars=2).collect()
    assert sorted(r.slot for r in rows) == list(range(24_200))
    assert all(r.release <= r.slot < r.deadline for r in rows)
    # Equal weights: every source has its first block before any has its second.
    assert {r.block for r in rows if r.slot < 12_100} == {0}


def brute_vectors(rows, least=0.9):
    sound = {}
    for i, r in enumerate(rows):
        v = r.embedding
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            sound[i] = np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = Counter()
    for a in sound:
        for b in sound:
            if a < b and len(sound[a]) == len(sound[b]) and sound[a] @ sound[b] >= least - 1e-12:
                links[a] += 1
                links[b] += 1
                root[find(b)] = find(a)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r.vec_id)
    least_key = {g: min((x for x in k if x is not None), default=None) for g, k in groups.items()}
    return sorted(((r.vec_id, links[i], least_key[find(i)]) for i, r in enumerate(rows)), key=str)


def found_vectors(df):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in df.collect()), key=str)


def test_vectors_equal_all_pairs(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert found_vectors(vector_dedup.vector_duplicates(table)) == brute_vectors(table.collect())


def test_vectors_of_edges(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=8)
    rows = [(i, (base + rng.normal(size=8) * 0.05).astype("f4").tolist()) for i in range(120)]
    rows += [(200 + i, rng.normal(size=8).astype("f4").tolist()) for i in range(60)]
    same = rows[3][1]
    rows += [(300, same), (301, same), (301, same), (None, same), (302, [2 * x for x in same])]
    rows += [(400, None), (401, []), (402, [0.0] * 8), (403, [1.0, None] * 4), (404, [float("nan")] * 8)]
    rows += [(405, [float("inf")] * 8), (406, [1.0, 0.0]), (407, [1.0, 0.1]), (408, [3.0]), (409, [1e38] * 8)]
    table = spark.createDataFrame(
        [(i, v, "?", "?") for i, v in rows], "vec_id bigint, embedding array<float>, node string, kept string"
    )
    got = vector_dedup.vector_duplicates(table)
    assert found_vectors(got) == brute_vectors(table.collect())
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.collect())
    assert vector_dedup.vector_duplicates(table.filter("false")).count() == 0


def test_graph_finds_neighbours_and_widens():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(40, 16))
    points = np.concatenate([centres[rng.integers(0, 40, 1_500)] + rng.normal(size=(1_500, 16)) * 0.15,
                             centres[0] + rng.normal(size=(700, 16)) * 0.1])
    points = (points / np.linalg.norm(points, axis=1)[:, None]).astype(np.float32)
    graph = Hnsw(points)
    found = graph.within(points[::5], 0.9, 16)
    true = points[::5] @ points.T >= 0.9
    assert sum(map(len, found)) >= 0.98 * true.sum()
    assert all(true[i, f].all() for i, f in enumerate(found))
    assert len(found[-1]) > 600  # wider than the first beam by far


def sparse_and_dense(rng, dims=32):
    """Vectors of one large group, of pairs and of singles, and the other half of the pairs."""
    unit = lambda v: v / np.linalg.norm(v, axis=1)[:, None]
    group = unit(rng.normal(size=dims) + rng.normal(size=(1_500, dims)) * 0.1)
    singles = unit(rng.normal(size=(3_000, dims)))
    return np.concatenate((group, singles)), unit(singles[:1_500] + 0.05 * rng.normal(size=(1_500, dims)))


def test_audit_sees_lost_pairs():
    nodes, foreign = sparse_and_dense(np.random.default_rng(2))
    for given in (foreign, foreign[:0]):  # real pairs, and planted ones alone
        shard = vector_dedup._Shard(np.arange(len(nodes)), np.ones(len(nodes), int), nodes, 0.9)
        within = shard.graph.within

        def lossy(queries, least, beam):
            """Loses isolated pairs, and nothing else, below a beam of 90."""
            found = within(queries, least, beam)
            inside = (queries @ shard.graph.vectors.T).max(axis=1) > 1 - 1e-6
            return [f if beam > 90 or i or len(f) > 5 else f[:0] for f, i in zip(found, inside)]

        shard.graph.within = lossy
        shard.audit(given)
        assert shard.beam > 90


def test_foreign_vectors_find_their_pairs():
    nodes, foreign = sparse_and_dense(np.random.default_rng(3))
    shard = vector_dedup._Shard(np.arange(len(nodes)), np.ones(len(nodes), int), nodes, 0.9)
    shard.audit(foreign[:700])
    true = (foreign @ nodes.T >= 0.9).sum(axis=1)
    found = [n for n, _ in shard.answer(np.arange(len(foreign)) + 10_000, foreign)]
    assert np.mean([f / t for f, t in zip(found, true) if t]) > 0.99


def test_forest_joins_once():
    forest = vector_dedup._Forest(6)
    assert forest.join_all(np.array([1, 3, 5])) == [(1, 3), (1, 5)]
    assert forest.join_all(np.array([3, 5])) == []
    assert forest.join_all(np.array([0, 5])) == [(0, 5)]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    toxic = {r.doc_id for r in queries.op3_toxicity(spark, SF).filter("toxic").collect()}
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in docs.collect()} - toxic
    for name, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, kept, SF).columns == docs.columns, name
    masked = corpus_pipeline.mask_secrets(spark, docs, SF)
    assert masked.count() == docs.count()
    assert masked.filter("n_chars <> length(text)").isEmpty()
    assert masked.filter(F.col("text").rlike("[0-9a-f]{24}")).isEmpty()
    mixed = corpus_pipeline.mix(spark, docs, SF)
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in docs.collect())


def test_pipeline_keeps_one_row_of_each_group(spark):
    base = "one two three four five six seven eight"
    other = "a very different text that has nine words here"
    rows = [
        (1, base, "a"), (1, base, "a"), (1, base, "b"),  # repeated rows
        (None, base.upper(), "c"),  # a copy without an id
        (2, other, "a"), (2, base, "a"),  # two texts under one id, one of them a copy
        (None, "only rows that have no id at all are in this", "x"), (None, "only rows that have no id at all are in this", "y"),
        (3, None, "a"), (3, None, "a"), (4, " \n", "a"), (None, "", "a"),  # linked with nothing
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    want = [(1, base), (2, other), (None, rows[6][1]), (3, None), (3, None), (4, " \n"), (None, "")]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(want)
    empty = corpus_pipeline.drop_near_duplicates(spark, docs.filter("false"), SF)
    assert empty.count() == 0


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) and 100 < len(ids) < 200
    assert all(r.n_tokens == len(r.ids) for r in rows)
