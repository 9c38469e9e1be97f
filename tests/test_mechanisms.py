"""Neighbour index, refreshed views, variants, keyed state."""

import datetime as dt
import json
import os
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from contentloom import schemas
from contentloom.functions import variants
from contentloom.operators import hamming, neighbours, refresh as refreshing, sketches
from contentloom.operators.neighbours import build_vector_index, nearest_neighbours, probes_for
from contentloom.operators.refresh import KeyedView, refresh
from contentloom.plans import enrichment_queries
from contentloom.session import scratch_path, scratch_table, written
from contentloom.sources import blocks, payloads, tables
from contentloom.streaming import views


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- neighbours ----------------------------------------------------------------------------------


def plain_neighbours(rows, k):
    fit = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    width = max(len(v) for _, v in fit)
    unit = np.array([np.pad(v / np.abs(v).max(), (0, width - len(v))) for _, v in fit])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    cosines = np.round(unit @ unit.T, 6)
    out = []
    for n, (i, _) in enumerate(fit):
        found = sorted((-c, fit[m][0], m) for m, c in enumerate(cosines[n]) if m != n)[:k]
        out += [(i, rank, j, round(-c, 6)) for rank, (c, j, _) in enumerate(found, 1)]
    return sorted(out, key=str)


def clustered(n, centers, seed, noise=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centers, 8))
    return [(i, (middle[i % centers] + noise * rng.normal(size=8)).tolist()) for i in range(n)]


@pytest.mark.parametrize("block", [5, 40])
def test_neighbours_are_exact_in_small_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", block)
    test_neighbours_are_exact(spark, monkeypatch, 7)


@pytest.mark.parametrize("part", [2048, 7])
def test_neighbours_are_exact(spark, monkeypatch, part):
    """Random, clustered, equal, odd and tiny vectors; one and many parts of a cell."""
    monkeypatch.setattr(neighbours, "PART_ROWS", part)
    rng = np.random.default_rng(3)
    rows = clustered(90, 6, 1) + [(100 + i, rng.normal(size=8).tolist()) for i in range(60)]
    rows += [(200 + i, rows[0][1]) for i in range(12)]
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [float("nan")] * 8), (304, [1.0, None]), (305, [1e-200, 2e-200]), (306, [3e200])]
    vectors = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, v array<double>, cell int").repartition(3)
    index = build_vector_index(vectors, "vec_id", "v", cells=6)
    got = sorted(((r.query_id, r.rank, r.neighbour_id, r.similarity) for r in nearest_neighbours(index, 4).collect()), key=str)
    assert got == plain_neighbours(rows, 4)
    some = nearest_neighbours(index, 4, queries=F.col("key") % 10 == 0).collect()
    assert sorted(((r.query_id, r.rank, r.neighbour_id, r.similarity) for r in some), key=str) == [g for g in got if g[0] % 10 == 0]
    assert nearest_neighbours(build_vector_index(vectors.limit(0), "vec_id", "v"), 4).count() == 0


def test_far_cells_are_not_visited(spark, monkeypatch):
    """With clear clusters a query reaches its own cell only."""
    vectors = spark.createDataFrame(clustered(400, 8, 5), "vec_id long, v array<double>")
    index = build_vector_index(vectors, "vec_id", "v", cells=8)
    unit = np.array([r.vec for r in index.rows.select("vec").collect()])
    theta = np.full(len(unit), 0.9)
    reached = neighbours._reachable(unit, theta, index.cells, None)
    assert reached.sum() < 2 * len(unit) and reached.any(axis=1).all()


def test_recall_of_probes(spark, sf_dir="/root/testdata/sf0.01"):
    """The given vectors have no clusters; the number of probes follows from the wanted recall."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    index = build_vector_index(vectors, "vec_id", "embedding", cells=12)
    exact = {(r.query_id, r.neighbour_id) for r in nearest_neighbours(index, 5).collect()}
    few, many = probes_for(index, 5, 0.5), probes_for(index, 5, 0.95)
    assert few < many <= 12
    found = {(r.query_id, r.neighbour_id) for r in nearest_neighbours(index, 5, probes=many).collect()}
    assert len(found & exact) >= 0.9 * len(exact)


def test_probes_need_memory_for_rows_times_cells_only():
    """Cells compared with each other per row took 10 GB for a batch of vectors and 1,000 cells."""
    rng = np.random.default_rng(2)
    unit = rng.normal(size=(400, 16))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    n = len(unit)
    cells = neighbours.Cells(unit, np.full(n, -1.0), np.ones(n, int), np.ones(n, int))
    tracemalloc.start()
    can = neighbours._reachable(unit, np.full(n, -np.inf), cells, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * n * n
    near = unit @ unit.T
    assert (can == ((near[:, None, :] > near[:, :, None]).sum(axis=2) < 3)).all()


def test_rows_travel_once_for_each_block_of_queries(spark, monkeypatch):
    """Vectors without clusters reach all cells; blocks, not cells, are what travels."""
    stored = {}

    def recorded(df, name):
        stored[name] = written(df, name)
        return stored[name]

    monkeypatch.setattr(neighbours, "written", recorded)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 150)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(600)]
    index = build_vector_index(spark.createDataFrame(rows, "vec_id long, v array<double>"), "vec_id", "v", cells=40)
    found = nearest_neighbours(index, 4, queries=F.col("key") % 20 == 0).collect()
    got = sorted(((r.query_id, r.rank, r.neighbour_id, r.similarity) for r in found), key=str)
    assert got == [x for x in plain_neighbours(rows, 4) if x[0] % 20 == 0]
    assert stored["visits"].count() <= 8


@pytest.fixture
def few_vectors(spark, tmp_path):
    """A folder with 70 vectors, ids 1 to 70."""
    rows = [(i + 1, v) for i, v in clustered(70, 4, 9, noise=0.3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path), [(r.vec_id, r.embedding) for r in table.collect()]


def test_vector_neighbours_asks_for_every_vector(spark, few_vectors):
    """Once only ids divisible by 20 were queries."""
    folder, rows = few_vectors
    found = enrichment_queries.vector_neighbours(spark, folder).collect()
    assert sorted(((r.query_id, r.rank, r.neighbour_id, r.similarity) for r in found), key=str) == plain_neighbours(rows, 5)


def test_vector_neighbours_probed_asks_for_every_vector(spark, few_vectors):
    found = enrichment_queries.vector_neighbours_probed(spark, few_vectors[0]).first()
    assert (found.n_rows, found.n_found) == (70, 350)


def test_travelling_blocks_grow_with_the_table(spark, monkeypatch):
    """With blocks of one size, the rows that travel grew with the square of the table."""
    assert neighbours._travel_rows(1000, 64) == neighbours.BLOCK_ROWS
    assert neighbours._travel_rows(600_000, 64) == 50_000
    assert neighbours._travel_rows(10**9, 64) * 64 * 8 <= neighbours.BLOCK_BYTES
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 10)
    monkeypatch.setattr(neighbours, "BLOCKS", 4)
    test_neighbours_are_exact(spark, monkeypatch, 7)


def test_equal_vectors_are_ranked_by_key(spark):
    """Many ties, and cosines that single precision does not tell apart."""
    rng = np.random.default_rng(8)
    base = rng.normal(size=8)
    rows = [(i, base.tolist()) for i in range(40)] + [(40 + i, (base + 1e-3 * rng.normal(size=8)).tolist()) for i in range(80)]
    index = build_vector_index(spark.createDataFrame(rows, "vec_id long, v array<double>"), "vec_id", "v", cells=3)
    got = sorted(((r.query_id, r.rank, r.neighbour_id, r.similarity) for r in nearest_neighbours(index, 6).collect()), key=str)
    assert got == plain_neighbours(rows, 6)


def test_plan_has_no_product(spark):
    index = build_vector_index(spark.createDataFrame(clustered(50, 2, 1), "vec_id long, v array<double>"), "vec_id", "v", cells=2)
    plan = nearest_neighbours(index, 3)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


# ---- refreshed views -----------------------------------------------------------------------------


@pytest.fixture
def view(spark):
    """Names joined to the newest of their notes, in 8 partitions."""
    tables_ = {name: scratch_table(spark, name) for name in ("names", "notes")}
    refreshing.write_parted(spark.createDataFrame([(i, f"n{i}") for i in range(20)], "id long, name string"), tables_["names"], "id", 8)
    refreshing.write_parted(spark.createDataFrame([(i, 1, "old") for i in range(0, 20, 2)], "id long, at int, note string"), tables_["notes"], "id", 8)

    def build(f):
        newest = f["notes"].groupBy("id").agg(F.max_by("note", "at").alias("note"))
        return f["names"].join(newest, "id", "left").select("id", "name", "note")

    return KeyedView(scratch_table(spark, "view"), "id", "names", tables_, build, 8)


def add(spark, view, name, rows, ddl):
    df = spark.createDataFrame(rows, ddl)
    tables.append(df.withColumn("part", refreshing.part_of("id", view.parts)), view.sources[name])


def shown(spark, view):
    return rows_of(spark.table(view.target).select("id", "name", "note"))


def whole(spark, view):
    return rows_of(view.build({n: spark.table(t) for n, t in view.sources.items()}))


def test_refresh_rewrites_what_changed(spark, view):
    assert refresh(spark, view).mode == "built"
    assert shown(spark, view) == whole(spark, view)
    before = set(spark.table(view.target).inputFiles())
    assert refresh(spark, view) == refreshing.Refresh("unchanged")

    add(spark, view, "notes", [(2, 5, "new"), (2, 0, "late and outdated"), (777, 9, "of no name")], "id long, at int, note string")
    done = refresh(spark, view)
    assert (done.mode, done.keys, done.partitions) == ("refreshed", 1, 1)
    assert shown(spark, view) == whole(spark, view) and (2, "n2", "new") in shown(spark, view)
    after = set(spark.table(view.target).inputFiles())
    parts = {f.split("part=")[1].split("/")[0] for f in before ^ after}
    assert len(parts) == 1

    add(spark, view, "names", [(50, "n50"), (51, "n51")], "id long, name string")
    add(spark, view, "notes", [(3, 1, "first")], "id long, at int, note string")
    done = refresh(spark, view)
    assert (done.mode, done.keys) == ("refreshed", 3) and done.partitions <= 3
    assert shown(spark, view) == whole(spark, view) and len(shown(spark, view)) == 22
    assert refresh(spark, view) == refreshing.Refresh("unchanged")


def test_refresh_after_a_rewritten_source(spark, view):
    refresh(spark, view)
    tables.delete_where(view.sources["names"], spark, F.col("id") >= 10)
    done = refresh(spark, view)
    assert (done.mode, done.keys) == ("rebuilt", 10)
    assert shown(spark, view) == whole(spark, view) and len(shown(spark, view)) == 10


def test_refresh_is_repeated_after_a_crash(spark, view, monkeypatch):
    refresh(spark, view)
    add(spark, view, "notes", [(4, 7, "x")], "id long, at int, note string")
    real = refreshing._mark

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(refreshing, "_mark", dies)
    with pytest.raises(RuntimeError):
        refresh(spark, view)
    monkeypatch.setattr(refreshing, "_mark", real)
    assert refresh(spark, view).mode == "refreshed"
    assert shown(spark, view) == whole(spark, view)


def test_refresh_with_keys_beyond_a_broadcast(spark, view, monkeypatch):
    refresh(spark, view)
    monkeypatch.setattr(refreshing, "fits_broadcast", lambda df: False)
    add(spark, view, "notes", [(i, 3, "z") for i in range(5)], "id long, at int, note string")
    assert refresh(spark, view).keys == 5 and shown(spark, view) == whole(spark, view)


# ---- variants ------------------------------------------------------------------------------------

DOCUMENTS = [
    '{"a": {"b": "text"}, "n": 12, "f": 1.5, "t": true, "z": null, "l": ["x", 2, {"y": 1}], "s": "[1]", "q": "{"}',
    '{"a": "no object"}', '{"a": {"b": ""}}', "[1, 2]", '"just text"', "17", "", " ", None, "{bad", '{"a": {"b": "cut', '{"a": 1, "a": 2}',
    '{"a": {"b": "\\u00e9 \\"q\\" \\n"}}',
]
PATHS = ["$.a.b", "$.n", "$.f", "$.t", "$.z", "$.l", "$.l[1]", "$.s", "$.q", "$.a", "$.missing.deep", "$[0]"]


def plain_value(text, path):
    try:
        value = json.loads(text)
        for step in path[1:].replace("[", ".[").split(".")[1:]:
            value = value[int(step[1:-1])] if step.startswith("[") and isinstance(value, list) else value[step]
    except (TypeError, KeyError, ValueError, IndexError):
        return ""
    if value is None or isinstance(value, (dict, list)):
        return ""
    return str(value).lower() if isinstance(value, bool) else str(value)


def test_values_by_path(spark):
    docs = spark.createDataFrame(list(enumerate(DOCUMENTS)), "id int, raw string")
    fields = {f"p{i}": (p, "text") for i, p in enumerate(PATHS)}
    got = {r.id: r.v for r in docs.select("id", variants.read_once("raw", fields).alias("v")).collect()}
    for i, text in enumerate(DOCUMENTS):
        if text == '{"a": 1, "a": 2}':  # no variant holds it: scanned as text
            assert got[i].p9 in ("1", "2")
            continue
        assert list(got[i]) == [plain_value(text, p) for p in PATHS], text


def test_texts_by_path(spark):
    docs = spark.createDataFrame(list(enumerate(DOCUMENTS)), "id int, raw string")
    got = {r.id: r.v.l for r in docs.select("id", variants.read_once("raw", {"l": ("$.l", "texts")}).alias("v")).collect()}
    assert got[0] == ["x", "2", '{"y":1}'] and all(v == [] for i, v in got.items() if i)


def test_shape_of_documents(spark):
    docs = spark.createDataFrame([('{"a": 1}',), ('{"a": 2, "b": "x"}',), ("{bad",)], "raw string")
    assert docs.agg(variants.schema_report(variants.parsed("raw"))).first()[0] == "OBJECT<a: BIGINT, b: STRING>"


def test_payloads_are_parsed_once(spark):
    """One parse per payload in the plan of every format, two where it holds a document."""
    rows = spark.createDataFrame([(1, None, None, '{"markdown": "x"}', "paragraph")], "id int, created_at timestamp, retrieved_at timestamp, content string, app string")
    for app, times in (("paragraph", 1), ("lens", 1), ("mirrorxyz", 1), ("cyberconnect", 2)):
        plan = payloads.extract_app(rows, app)._jdf.queryExecution().optimizedPlan().toString()
        parses = plan.count("parseJson") + plan.count("try_parse_json") + plan.count("parse_json")
        of_containers = plan.count("schema_of_variant(variant_get(")
        assert parses >= times, plan
        assert of_containers == 0


def test_payload_with_repeated_names(spark):
    """No variant holds it, and it is read all the same."""
    raw = '{"markdown": "body", "title": "t", "x": 1, "x": 2, "authors": ["who", "b"], "categories": ["c"]}'
    rows = spark.createDataFrame([(1, None, None, raw, "paragraph")], "id int, created_at timestamp, retrieved_at timestamp, content string, app string")
    for got in (payloads.extract_app(rows, "paragraph").first(), payloads.extract_all(rows).first()):
        assert (got.body, got.title, got.contributor, got.tags, got.content_timestamp) == ("body", "t", "who", ["c"], "")


def test_blocks_keep_the_record(spark):
    raw = spark.createDataFrame(
        [('{"height": 7, "timestamp": 1700000000, "txs": ["a", "b"]}',), ('{"height": "8", "timestamp": 1700000000}',), ("",)], "response_str string"
    )
    parsed = blocks.parse_blocks(raw)
    assert tables.to_schema(parsed, schemas.BLOCKS).schema["data_raw"].dataType.simpleString() == "variant"
    table = scratch_table(spark, "blocks")
    tables.to_schema(parsed, schemas.BLOCKS).write.format("parquet").saveAsTable(table)
    got = spark.table(table).select("height", F.variant_get("data_raw", "$.txs[1]", "string").alias("tx")).collect()
    assert [tuple(r) for r in got] == [(7, "b")]


# ---- streams -------------------------------------------------------------------------------------


def test_newest_row_across_restarts(spark):
    base = scratch_path(spark, "newest-test")
    ddl = "k int, ts timestamp, n int"
    at = lambda s: dt.datetime(2024, 1, 1, 0, 0, s)
    files = [
        [(1, at(5), 1), (1, at(9), 2), (2, at(1), 3), (3, None, 4), (None, at(3), 5)],
        [(1, at(8), 6), (2, at(2), 7), (4, at(1), 8), (None, at(2), 9)],
        [(1, at(9), 2), (1, at(9), 10), (2, at(2), 7)],
    ]
    seen = []
    with views.keyed_state(spark):
        for rows in files:
            spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{base}/in")
            stream = views.file_stream(spark, f"{base}/in", ddl)
            changes = views.newest_changes(stream, ["k"], ["ts", "n"], dt.timedelta(days=1))
            views.run_updates_to_table(changes, f"{base}/out", f"{base}/checkpoint")
            now = {tuple(r) for r in spark.read.parquet(f"{base}/out").select("k", "n").collect()}
            seen.append(now - set().union(*seen))
    assert seen == [{(1, 2), (2, 3), (None, 5)}, {(2, 7), (4, 8)}, {(1, 10)}]
    assert os.path.isdir(f"{base}/checkpoint".removeprefix("file:"))
    assert "HDFS" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_index_rows_before_and_after_their_payload(spark):
    base = scratch_path(spark, "late-test")
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    payload_files = [[(1, at(0)), (2, at(1))], [(3, at(20))], [(4, at(90))], [(5, at(200))]]
    index_files = [[(2, at(0))], [(1, at(8)), (3, at(21))], [(9, at(90))], [(8, at(200))]]
    for p, i in zip(payload_files, index_files, strict=True):
        spark.createDataFrame(p, "id int, retrieved_at timestamp").coalesce(1).write.mode("append").parquet(f"{base}/p")
        rows = [(k, t, t, f"app{k}", t, 7) for k, t in i]
        spark.createDataFrame(rows, "id int, created_at timestamp, created_at_dt timestamp, app string, indexed_at timestamp, data_size int").coalesce(1).write.mode("append").parquet(f"{base}/i")
        streams = [views.file_stream(spark, f"{base}/{x}", spark.read.parquet(f"{base}/{x}").schema) for x in "pi"]
        views.run_to_table(views.tracker_with_late_index(*streams, "10 minutes"), f"{base}/out", f"{base}/check")
    got = {(r.id, r.app) for r in spark.read.parquet(f"{base}/out").collect()}
    assert {(1, "app1"), (2, "app2"), (3, "app3")} <= got
    assert got - {(1, "app1"), (2, "app2"), (3, "app3")} <= {(4, None)}


# ---- sketches and fingerprints -------------------------------------------------------------------


def test_sketches_of_days_make_those_of_months(spark):
    rows = [(dt.date(2024, 1 + i % 3, 1 + i % 28), i % 700, i % 1000) for i in range(6000)] + [(None, 1, 1), (dt.date(2024, 5, 1), None, None)]
    df = spark.createDataFrame(rows, "day date, who int, v int").repartition(5)
    daily = sketches.daily_sketches(df, "day", "who", "v")
    month = F.date_trunc("month", "day").cast("date").alias("month")
    got = {r.month.month: r for r in sketches.figures(sketches.merged(daily, month), median=0.5).collect()}
    assert set(got) == {1, 2, 3, 5}
    for m in (1, 2, 3):
        mine = [r for r in rows if r[0] and r[0].month == m]
        assert got[m].n == len(mine) and got[m].total == sum(r[2] for r in mine)
        exact = len({r[1] for r in mine})
        assert abs(got[m].n_actors - exact) <= 0.1 * exact
        assert abs(sum(r[2] <= got[m].median for r in mine) / len(mine) - 0.5) < 0.02
    assert (got[5].n, got[5].n_actors, got[5].median) == (1, 0, None)


def test_fingerprints_few_bits_apart(spark):
    """Against every pair, with one hot block and with negative values."""
    rng = np.random.default_rng(9)
    base = rng.integers(-(2**63), 2**63 - 1, 40)
    near = [int(v) ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 6), replace=False)) for v in base for _ in range(4)]
    hot = [int(v) & ~0xFFFF for v in rng.integers(-(2**62), 2**62, 60)]
    values = sorted({*map(int, base), *near, *hot, 0, -1, 1})
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values, *values[:5]])] + [(999, None)], "id int, h long")
    counted, members = hamming.clusters(df, "id", "h")
    assert members.count() == len(values) + 5 and counted.agg(F.sum("n")).first()[0] == len(values) + 5
    for distance in (1, 3):
        got = {(r.a, r.b): r.distance for r in hamming.near_fingerprints(counted, distance).collect()}
        apart = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count()
        want = {(a, b): apart(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if apart(a, b) <= distance}
        assert got == want and want
