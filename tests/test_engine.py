import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessel.operators import batches, models, search, select, text
from tessel.plans import catalogue
from tessel.sources import tables

SF = "/root/testdata/sf0.001"


def rounded(rows):
    fix = lambda v: [fix(x) for x in v] if isinstance(v, (list, np.ndarray)) else round(float(v), 6) if isinstance(v, float) else v
    return sorted((repr([fix(v) for v in r]) for r in rows))


def test_entry(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize(("n", "lengths"), [(0, [0]), (1, [1]), (500, [500]), (501, [500, 51]), (901, [500, 451]), (949, [500, 499]), (950, [500, 500, 50]), (1000, [500, 500, 100])])
def test_window_lengths(spark, n, lengths):
    rows = text.token_windows(spark.createDataFrame([(n, " ".join(["w"] * n))], "doc_id long, text string"), 500).orderBy("chunk_index").collect()
    assert [r.chunk_token_count for r in rows] == lengths


def test_null_text_is_one_empty_chunk(spark):
    assert [r.chunk_token_count for r in text.token_windows(spark.createDataFrame([(1, None)], "doc_id long, text string"), 5).collect()] == [0]


def test_packing_holds_the_limit_and_loses_nothing(spark):
    rows = spark.createDataFrame([(0, i, n) for i, n in enumerate([3, 50, 7, 7, 7, 200, 1])], "shard int, id long, chunk_token_count long")
    got = batches.pack(rows, 40, 0, "shard", ["id"]).toPandas()
    assert len(got) == 7
    for _, g in got.groupby("batch_id"):
        assert len(g) == 1 or g.n.max() * len(g) <= 40
    assert got.batch_id.min() == 0


def test_packing_equals_a_scan_row_by_row(spark):
    rng = np.random.default_rng(2)
    rows = [(s, i, int(n)) for s in (0, 1, None) for i, n in enumerate(rng.integers(0, [12, 60, 30][s or 0], 150))]
    got = {(r.shard, r.id): r.batch_id for r in batches.pack(spark.createDataFrame(rows, "shard int, id long, chunk_token_count long"), 40, 0, "shard", ["id"]).collect()}
    assert len(got) == len(rows)
    for s in (0, 1, None):
        batch, k = 0, 0
        for n, i in sorted((n, i) for own, i, n in rows if own == s):
            if k and (k + 1) * n > 40:
                batch, k = batch + 1, 0
            k += 1
            assert got[s, i] == batch


def test_two_phases_with_enough_local_rows_are_exact(spark):
    rows = spark.range(400).selectExpr("id as vec_id", "id % 4 as shard", "id % 5 as feature", "(id * 37 % 101) / 10.0 as activation")
    order = catalogue._order()
    a = select.top_n(rows, ["feature"], order, 10)
    assert sorted(a.collect()) == sorted(select.top_n_two_phase(rows, "shard", ["feature"], order, 10, 10).collect())


def test_sparse_codes_equal_numpy(spark):
    x = np.random.default_rng(0).normal(size=(20, 8)).round(3)
    w = models.formula_weights(16, 8)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    for r in models.sparse_encode(rows, "id", "v", w, 3).collect():
        acts = np.maximum(w @ x[r.id], 0).round(6)
        top = sorted(range(16), key=lambda j: (-acts[j], j))[:3]
        assert r.top_indices == [float(j) for j in top]
        assert np.allclose(r.top_acts, acts[top])


def test_raw_matrix_round_trip_and_holes(spark, tmp_path):
    rows = spark.createDataFrame([("a", i, [float(i), 0.5]) for i in range(5)], "shard string, row_pos long, vector array<float>")
    tables.write_f32(rows, str(tmp_path / "m")).collect()
    with open(tmp_path / "m" / "a.npy", "ab") as f:
        f.write(b"xyz")  # a partial row
    assert sorted((r.row_pos, r.vector) for r in tables.read_f32(spark, f"file:{tmp_path}/m", 2).collect()) == [(i, [float(i), 0.5]) for i in range(5)]
    with pytest.raises(Exception, match="positions"):
        tables.write_f32(rows.where("row_pos <> 2"), str(tmp_path / "n")).collect()


def test_publish_retries(spark):
    calls = []

    def send():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy")

    assert tables.publish(send, 3, 0) == 3
    calls.clear()
    with pytest.raises(OSError, match="busy"):
        tables.publish(send, 2, 0)


def test_tables_are_replaced_not_overwritten(spark, tmp_path):
    path = f"file:{tmp_path}/t"
    spark.range(100).write.parquet(path)
    tables.replace_table(spark, path, lambda df: df.where("id > 49"))
    assert spark.read.parquet(path).count() == 50
    tables.write_sharded(spark.range(4).selectExpr("id", "id % 2 as shard"), f"{path}2")
    tables.write_sharded(spark.sql("select 9L as id, 1L as shard"), f"{path}2")
    assert sorted(r.id for r in spark.read.parquet(f"{path}2").collect()) == [0, 2, 9]


def test_arrow_files(spark, tmp_path):
    import pyarrow as pa

    t = pa.table({"id": pa.array([1, 2], pa.int64())})
    with pa.OSFile(str(tmp_path / "a.arrow"), "wb") as f, pa.ipc.new_file(f, t.schema) as w:
        w.write_table(t)
    assert tables.read_arrow(spark, f"file:{tmp_path}/a.arrow", "id long").count() == 2


@pytest.mark.parametrize("name", ["ann_ivf_recall", "ann_pq_recall"])
def test_recall_of_the_index(spark, name):
    rows = catalogue.QUERIES[name](spark, "/root/testdata/sf0.01").collect()
    assert all(r.recall >= 0.9 for r in rows if r.probes >= 0.7 * r.lists)
    assert sum(r.probes >= 0.7 * r.lists for r in rows) == 2


def test_corpora_are_read_by_glob_by_name_and_in_part(spark, tmp_path):
    for i in range(3):
        spark.createDataFrame([(f"t{i}{j}", j) for j in range(4)], "text string, k int").coalesce(1).write.parquet(f"{tmp_path}/part{i}")
        name = tables.list_shards(spark, f"{tmp_path}/part{i}", ".parquet")[0]
        tables.copy(spark, f"{tmp_path}/part{i}/{name}", f"{tmp_path}/all/data-{i:05d}-of-00003.parquet")
    names = tables.shard_names("data-{i:05d}-of-{n:05d}.parquet", 3)
    assert tables.list_shards(spark, f"{tmp_path}/all") == names
    every = tables.read_corpus(spark, f"{tmp_path}/all", keep=("k",))
    assert {(r.text, r.k, r.shard, r.row_pos) for r in every.collect()} == {(f"t{i}{j}", j, names[i], j) for i in range(3) for j in range(4)}
    assert tables.read_corpus(spark, f"{tmp_path}/all", shards=names[1:2]).count() == 4 and tables.read_corpus(spark, f"{tmp_path}/all", n=5).count() == 5
    assert tables.read_corpus(spark, f"{tmp_path}/all/data-0000[01]*.parquet").count() == 8
    assert spark.read.parquet("file:" + tables.fetch_shard(spark, f"{tmp_path}/all", names[2], f"{tmp_path}/got.parquet")).count() == 4
    got = tables.fetch_shard(spark, f"{tmp_path}/all", names[2], f"{tmp_path}/got.arrow", arrow=True)
    assert {r.text for r in tables.read_arrow(spark, got, "text string, k int").collect()} == {f"t2{j}" for j in range(4)}


def test_tables_are_published_appended_and_reused(spark, tmp_path, monkeypatch):
    rows, path = spark.range(300).withColumn("shard", F.col("id") % 3), f"{tmp_path}/table"
    calls, copy = [], tables.copy
    monkeypatch.setattr(tables, "copy", lambda *a: (calls.append(1), copy(*a) if len(calls) > 2 else 1 / 0)[1])
    assert tables.publish_table(rows, path, 99, wait=0) == 3
    assert len(tables.list_shards(spark, path, ".parquet")) == 99 and spark.read.parquet(path).count() == 300
    monkeypatch.setattr(tables, "copy", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        tables.publish_table(rows, path, 2, attempts=2, wait=0)
    tables.write_sharded(rows.where("shard = 0"), f"{tmp_path}/vectors")
    tables.write_sharded(rows.where("shard > 0"), f"{tmp_path}/vectors", mode="append")
    tables.write_sharded(rows.where("shard = 1 and id < 10"), f"{tmp_path}/vectors")
    assert {r.shard: r["count"] for r in spark.read.parquet(f"{tmp_path}/vectors").groupBy("shard").count().collect()} == {0: 100, 1: 3, 2: 100}
    built = []
    build = lambda: (built.append(1), rows)[1]
    assert [tables.reuse(spark, f"{tmp_path}/kept", build, fresh=f).count() for f in (False, False, True)] == [300] * 3 and len(built) == 2


def test_shard_jobs_fail_fast_or_collect_errors():
    tried = []

    def job(name):
        tried.append(name)
        if name == "b" or name == "c" and tried.count("c") < 3:
            raise OSError(name)
        return name.upper()

    done, failed = tables.for_each_shard(["a", "b", "c"], job, collect_errors=True, attempts=3)
    assert done == {"a": "A", "c": "C"} and list(failed) == ["b"] and tried.count("b") == 3
    with pytest.raises(OSError):
        tables.for_each_shard(["a", "b"], job, at_once=1)


def test_a_tensor_file_is_read_by_numpy(spark, tmp_path):
    rows = spark.createDataFrame([(0, i, [float(i), 0.5]) for i in range(5)], "shard int, row_pos long, vector array<float>")
    tables.write_f32(rows, str(tmp_path), header=True).collect()
    assert np.load(f"{tmp_path}/0.npy").tolist() == [[float(i), 0.5] for i in range(5)]


def test_a_zip_of_unequal_parts_is_an_error(spark):
    a, b = (select.with_position(spark.range(n).withColumn("shard", F.col("id") % 2), "shard", "id").withColumnRenamed("id", c) for n, c in ((10, "x"), (9, "y")))
    with pytest.raises(ValueError, match="differ"):
        select.zip_by_position(a, b)
    assert select.zip_by_position(a, a.withColumnRenamed("x", "z")).count() == 10 and select.zip_by_position(a, b, check=False).count() == 9


def test_lookup_keeps_order_and_repeats(spark):
    rows = spark.createDataFrame([(s, i, f"{s}{i}") for s in "ab" for i in range(3)], "shard string, row_pos long, v string")
    asked = spark.createDataFrame([(0, "b", 2), (1, "a", 0), (2, "b", 2), (3, "a", 9)], "ord int, shard string, row_pos long")
    assert [r.v for r in select.lookup(asked, rows, "ord").collect()] == ["b2", "a0", "b2", None]


def test_windows_of_a_tokenizer_file(spark):
    import os

    path = "/opt/tokenizers/byte_bpe_50k.json"
    if not os.path.exists(path):
        pytest.skip("no tokenizer files here")
    texts = ["one two three " * 60, "", None, "short text"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokenizer = text.TokenizerFile(path)
    for r in text.token_windows_by(docs, 50, lambda: text.TokenizerFile(path), special_tokens=False).collect():
        ids = tokenizer.encode([texts[r.doc_id] or ""], False)[0]
        assert r.chunk_tokens == ids[r.chunk_index * 45 : r.chunk_index * 45 + 50] and r.chunk_token_count == len(r.chunk_tokens)
        assert r.chunk_text == (texts[r.doc_id] if len(ids) <= 50 else tokenizer.decode(r.chunk_tokens))


def test_neighbours_of_several_vectors_and_a_stored_index(spark, tmp_path):
    x = np.random.default_rng(1).normal(size=(400, 16))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(400, None)], "id long, v array<double>")
    asked = rows.where("id % 50 = 0")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for block in (1000, 3):
        got = {(r.query, r.id) for r in search.nearest(rows, asked, "id", "v", 5, block).collect()}
        assert got == {(q, int(i)) for q in range(0, 400, 50) for i in np.argsort(-x @ x[q], kind="stable")[:5]}
    exact = search.exact_search(rows, asked, "id", "v", 10)
    search.build_index(rows, "id", "v", f"{tmp_path}/flat")
    search.build_index(rows, "id", "v", f"{tmp_path}/pq", sub_vectors=4, codes=32)
    full = search.search_index(spark, f"{tmp_path}/flat", rows, asked, "id", "v", 10)
    assert {(r.query, r.id) for r in full.collect()} == {(q, int(i)) for q in range(0, 400, 50) for i in np.argsort(-u @ u[q], kind="stable")[:10]}
    assert search.recall(search.search_index(spark, f"{tmp_path}/flat", rows, asked, "id", "v", 10, probes=14), exact, "id").first().recall >= 0.9
    assert search.recall(search.search_index(spark, f"{tmp_path}/pq", rows, asked, "id", "v", 10, shortlist=100), exact, "id").first().recall >= 0.9


def test_corpus_positions_run_over_all_files_by_key(spark, tmp_path):
    ids = np.random.default_rng(3).permutation(300) * 7 - 50
    for k in range(3):
        spark.createDataFrame([("t", int(i), f"l{i}") for i in ids[k * 100 : k * 100 + 100]], "text string, doc_id long, lang string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    got = catalogue.QUERIES["corpus_positions"](spark, str(tmp_path))
    assert got.schema["row_pos"].dataType.simpleString() == "bigint"
    assert sorted(map(tuple, got.collect())) == [(i, n, f"l{i}") for n, i in enumerate(sorted(map(int, ids)))]


def test_total_positions_of_repeated_null_and_no_keys(spark):
    keys = [5] * 60 + [None, None] + list(range(40)) + [2**62, 2**62 + 1]
    rows = spark.createDataFrame(list(zip(keys, range(len(keys)), strict=True)), "k long, t long")
    got = [(r.k, r.t) for r in sorted(select.with_total_position(rows, "k", ("t",)).collect(), key=lambda r: r.row_pos)]
    assert got == sorted(zip(keys, range(len(keys)), strict=True), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    assert sorted(r.row_pos for r in select.with_total_position(rows, "k", ("t",)).collect()) == list(range(len(keys)))
    for none in (rows.where("k is null"), rows.where("t < 0")):
        assert [r.row_pos for r in select.with_total_position(none, "k", ("t",)).collect()] == list(range(none.count()))
