"""Each operator against a plain version, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessel.llm import chat, chosen_path, entries, langid, lines, mixing, phrases, pii, repetition, warc, winnow
from tessel.llm.common import scratch_path

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta omega sigma kappa lambda theta iota zeta rho tau phi chi".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_lines long, n_words long, score double, size long, node long"


def corpus(seed: int = 5) -> list[tuple]:
    """Copies, near copies, shared passages and lines, and every odd text."""
    r = random.Random(seed)
    say = lambda n: " ".join(r.choice(WORDS) + str(r.randrange(30)) for _ in range(n))
    passage, line, long = say(20), "All rights reserved to us.", say(90)
    texts = [say(40) for _ in range(12)] + [long, long, long.replace(long.split()[3], "other"), f"{say(9)} {passage} {say(9)}", f"{passage}", f"{say(5)} {passage}"]
    texts += [f"{say(4)}\n {line.upper()}\t\n{say(3)}" for _ in range(4)] + [None, "", " ", "\n\n", "x", "é" * 25, "a " * 40, "a b c d e f g h " * 6, say(3000)]
    rows = [(i * 3 + 1, t, ["en", "de", None][i % 3], ["s1", "s2", None, "s0"][i % 4], 9, 9, 0.5, 7, 7) for i, t in enumerate(texts)]
    return rows + [rows[0], (None, texts[0], "en", "s1", 9, 9, 0.5, 7, 7), (None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).cache()


@pytest.mark.parametrize("name", sorted(entries.SQL))
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    expected = con.sql(entries.SQL[name])
    got = entries.QUERIES[name](spark, SF).select(*expected.columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected.fetchall()))


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    items = spark.createDataFrame([], "item_id long, text string")
    for df in (
        repetition.repetition(none), mixing.mix_sources(none), chosen_path.near_duplicates(none), winnow.contamination(none, items), pii.find_personal_data(none),
        phrases.remove_repeated_passages(none), lines.drop_repeated_lines(none), langid.identify(none, langid.learn(none)),
        chat.read_back(chat.format_chat(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))),
    ):
        assert df.count() == 0
    assert not winnow.contamination(docs, items).where("contaminated").count()


def test_archives_are_salvaged():
    made = [warc.record("response", f"urn:page:{i}", "http://x", hashlib.sha256(p).hexdigest(), p, len(p), None) for i, p in enumerate([b"one" * 50, b"two" * 90, b"WARC/1.1 inside", b""])]
    whole = b"".join([warc.member(made[0]), made[1], warc.member(made[2]), warc.member(made[3])])
    assert [(r, len(found)) for _, _, r, found in warc.salvage(whole) if found or r] == [(None, 1)] * 4
    a = warc.member(made[0])
    hurt = a[:40] + bytes([a[40] ^ 255]) + a[41:] + b"junk" + made[1] + made[2].replace(b"inside", b"INSIDE") + warc.member(made[3]) + made[0][:-30]
    found = list(warc.salvage(hurt))
    assert [r["record_id"] for _, _, _, x in found for r in x] == ["urn:page:1", "urn:page:3"]
    gaps = [(s, e) for s, e, why, _ in found if why]
    assert gaps == [(0, len(a) + 4), (len(a) + 4 + len(made[1]), len(a) + 4 + len(made[1]) + len(made[2])), (len(hurt) - len(made[0]) + 30, len(hurt))]


def test_archive_round_trip_with_odd_pages(spark):
    pages = [(3, "u", "x" * 100), (1, "u", "x" * 100), (2, None, "x" * 99), (4, "a\r\nb", None), (None, "u", "é" * 60), (5, "u", ""), (6, "u", "\0" * 300)]
    warc.write_archives(spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, digest long"), path := scratch_path(spark, "t"))
    got = {r.record_id: r for r in warc.read_archives(spark, path).collect()}
    assert not [r for r in got.values() if r.kind == "gap"]
    for i, _, html in pages:
        r, data = got[f"urn:page:{'null' if i is None else i}"], (html or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", "urn:page:1") if i == 3 else ("response", None))


def test_an_archive_of_many_records_is_read_in_batches(spark):
    n = 2 * warc.BATCH_RECORDS + 5
    pages = spark.range(n, numPartitions=1).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("page "), F.col("id").cast("string")).alias("html"))
    warc.write_archives(pages, path := scratch_path(spark, "many"))
    got = warc.read_archives(spark, path)
    assert (got.count(), got.where("kind = 'record'").select("record_id").distinct().count()) == (n, n)


def test_repetition_equals_plain(docs):
    for r in repetition.repetition(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        if len(w) > 500:
            continue
        cover = lambda m: len({j for i in range(len(w) - m + 1) for j in range(i, i + m) if sum(w[k : k + m] == w[i : i + m] for k in range(len(w) - m + 1)) > 1})  # noqa: B023, E731
        longest = next((m for m in range(len(w) - 1, 0, -1) if len({tuple(w[i : i + m]) for i in range(len(w) - m + 1)}) < len(w) - m + 1), 0)
        assert (r.n_words, r.n_repeat_words, r.covered_words, r.longest_repeat) == (len(w), cover(8), cover(5), longest)


def test_long_repeats_take_memory_by_words_only():
    import tracemalloc

    n = 400_000
    symbols, row = np.zeros(n, np.int64), np.zeros(n, np.int64)
    tracemalloc.start()
    assert repetition.longest_repeats(symbols, row)[:3].tolist() == [n - 1, n - 1, n - 2]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250 * n


def test_longest_repeats_equal_plain():
    r = np.random.default_rng(3)
    for n, letters in [(60, 2), (60, 1), (80, 5), (50, 50)]:
        symbols, row = r.integers(-(2**62), 2**62, letters)[r.integers(0, letters, n)], np.repeat([0, 1], [n // 3, n - n // 3])
        plain = []
        for i in range(n):
            end = n // 3 if i < n // 3 else n
            begin = 0 if i < n // 3 else n // 3
            most = 0
            for j in range(begin, end):
                k = 0
                while i != j and max(i, j) + k < end and symbols[i + k] == symbols[j + k]:
                    k += 1
                most = max(most, k)
            plain.append(most)
        assert repetition.longest_repeats(symbols, row).tolist() == plain


def test_mixing_meets_targets(docs):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == docs.count()
    total, got = sum(r["size"] for r in rows), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
        got.setdefault(r.source, [0, r.target, r.source_size])[0] += r.taken
    for taken, target, size in got.values():
        assert abs(taken - target) <= 1 and target <= 3 * size + 1e-6
    assert abs(sum(t for _, t, _ in got.values()) - total) < 1
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix_sources(docs.repartition(3)).collect()))


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_all_pairs(docs, k, percent, monkeypatch):
    def plain(rows):
        sets = []
        for r in rows:
            w = re.findall(r"[^ \t-\r]+", (r[1] or "").translate({c: c + 32 for c in range(65, 91)}))
            sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
        comp = list(range(len(rows)))
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    comp = [comp[j] if c == comp[i] else c for c in comp]
        ids = {c: min((r[0] for r, x in zip(rows, comp, strict=True) if x == c and r[0] is not None), default=None) for c in comp}
        return sorted(repr((r[0], len(s), ids[c] if s else r[0])) for r, s, c in zip(rows, sets, comp, strict=True))

    rows = [tuple(r)[:2] for r in docs.collect()]
    base = rows[12][1].split()
    rows += [(1000 + i, " ".join(base[:i] + [f"new{i}"] + base[i + 1 :])) for i in range(60)]  # a crowd of near copies
    df = docs.sparkSession.createDataFrame(rows, "doc_id long, text string")
    assert sorted(repr(tuple(r)) for r in chosen_path.near_duplicates(df, k, percent).collect()) == plain(rows)
    monkeypatch.setattr(chosen_path, "CROWD", 16)  # the same by branching on
    assert sorted(repr(tuple(r)) for r in chosen_path.near_duplicates(df, k, percent).collect()) == plain(rows)


def test_contamination_equals_plain(spark, docs):
    texts = [r.text for r in docs.collect()]
    items = [(1, " ".join((texts[2] or "").split()[5:20])), (2, (texts[16] or "")[:90]), (3, "gamma4"), (10, "ALPHA1, beta2!"), (4, None), (5, "--"), (None, texts[3]), (1, " ".join(texts[2].split()[5:20]))]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    for r in winnow.contamination(docs, spark.createDataFrame(items, "item_id long, text string")).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        w, hit, found = words(r.text), set(), set()
        for item, text in items:
            v = words(text)
            m = min(len(v), 10)
            own = {tuple(v[i : i + m]) for i in range(len(v) - m + 1)} if m else set()
            for i in range(len(w) - m + 1) if m else ():
                if tuple(w[i : i + m]) in own:
                    hit |= set(range(i, i + m))
                    found |= {str(item)} - {"None"}
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())


def test_a_hot_passage_gives_a_row_for_each_place_not_each_pair(spark, monkeypatch):
    """One passage in all items and all documents."""
    passage = " ".join(f"p{i}" for i in range(16))
    items = spark.createDataFrame([(i, f"own{i} {passage} end{i}") for i in range(60)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"a{i} {passage} b{i}") for i in range(50)], "doc_id long, text string")
    saved = {}
    keep = winnow.save
    monkeypatch.setattr(winnow, "save", lambda df, name: saved.setdefault(name, keep(df, name)))
    got = winnow.contamination(docs, items).collect()
    ids = ",".join(sorted(str(i) for i in range(60)))
    assert {(r.n_hit, r.n_items, r.items_sha256) for r in got} == {(16, 60, hashlib.sha256(ids.encode()).hexdigest())}
    assert saved["windows_10"].where(F.size("ids") == 60).count() == 7 and max(t.count() for t in saved.values()) < 60 * 10


@pytest.mark.parametrize("marks", [("<|", "|>", "<|end|>"), ("ab", "x", "bc"), ("[", "]", "\n"), ("###", " says ", "###x"), ("aa", "a", "ba")])
def test_escapes_follow_from_any_template(spark, marks):
    template = chat.Template(*marks)
    r = random.Random(1)
    letters = [*"".join(marks), *marks, "\\", "a", "b", " ", "\n", "é"]
    turns = [(c, i, r.choice(["user", "us|>er", "a b", "x" + r.choice(letters), ""]), "".join(r.choice(letters) for _ in range(r.randrange(12)))) for c in range(30) for i in range(3)]
    segments = chat.format_chat(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"), template)
    segments.repartition(5).write.parquet(path := scratch_path(spark, "segments"))  # any order of rows
    got = {r.conv_id: r for r in chat.read_back(spark.read.parquet(path), template).collect()}
    for c in range(30):
        own = "".join(f"{role}\n{t}\n" for k, _, role, t in turns if k == c)
        assert (got[c].n_turns, got[c].turns_sha256) == (3, hashlib.sha256(own.encode()).hexdigest())


def test_templates_that_cannot_be_undone_are_refused():
    for marks in (("", "b", "c"), ("a", "b", ""), ("a\\", "b", "c"), ("a", "b", "abab")):
        with pytest.raises(ValueError, match="mark|overlap"):
            chat.Template(*marks)


def test_gaps_are_told_and_archives_bounded(spark):
    import os

    pages = [(i, f"u{i}", "x" * (40 + 1000 * (i % 3 == 0)) + str(i)) for i in range(60)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    warc.write_archives(df, path := scratch_path(spark, "bounded"), archive_records=32, archive_bytes=8192)
    got = warc.read_archives(spark, path)
    assert got.where("kind = 'record'").count() == 60
    by_file = got.groupBy("path").agg(F.sum("payload_bytes").alias("b"), F.count("*").alias("n")).collect()
    assert all(r.b <= 8192 and r.n <= 32 for r in by_file) and len(by_file) > 4
    name = by_file[0].path.removeprefix("file:")
    data = open(name, "rb").read()  # noqa: SIM115
    os.makedirs(hurt := name + ".d")
    with open(f"{hurt}/a.warc.gz", "wb") as f:
        f.write(b"junk" + data + b"WARC/1.1\r\nno end")
    rows = warc.read_archives(spark, f"file:{hurt}").orderBy("start_byte").collect()
    assert [(r.start_byte, r.end_byte, r.reason) for r in rows if r.kind == "gap"] == [(0, 4, "no member or version line"), (4 + len(data), 4 + len(data) + 16, "header without end")]
    assert sum(r.kind == "record" for r in rows) == by_file[0].n


def test_no_pages_and_repeated_page_ids(spark):
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path := scratch_path(spark, "none"))
    pages = [(1, "u", "y" * 200, 7), (1, "u", "y" * 200, 7), (None, "u", "y" * 200, 7), (2, "u", "y" * 200, 7), (None, "u", "z" * 200, 7), (None, "u", "z" * 200, 7)]
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string, first_id int"), path := scratch_path(spark, "ties"))
    got = sorted((r.record_id, r.record_type, r.refers_to or "") for r in warc.read_archives(spark, path).collect())
    assert got == sorted([("urn:page:1", "response", "")] * 2 + [("urn:page:2", "revisit", "urn:page:1"), ("urn:page:null", "revisit", "urn:page:1")] + [("urn:page:null", "response", "")] * 2)


def test_chat_reads_back_what_it_wrote(spark):
    odd = ["", "\\", "\\\\###", "</turn>\n", "### user: hi</turn>\n", "####", "\\</turn>", None, "é\n" * 3]
    turns = [(1, i, ["user", "assistant"][i % 2], t) for i, t in enumerate(odd)] + [(2, 0, "assistant", "x"), (3, 0, "system", "s"), (3, 1, "user", "u"), (None, None, None, None), (4, 1, "a:b#<\\", "t"), (4, 1, "a:b#<\\", "t")]
    got = {r.conv_id: r for r in chat.read_back(chat.format_chat(spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, seq long"))).collect()}
    for c in (1, 2, 3, 4, None):
        own = [(r or "", t or "") for k, _, r, t in turns if k == c]
        loss = "".join(t for r, t in own if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (len(own), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert [got[c].valid for c in (1, 2, 3, 4)] == [True, False, True, False]


def test_rows_of_a_key_stay_together_after_a_skewed_join(spark):
    from tessel.llm.common import save, together

    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = save(spark.range(40_000, numPartitions=8).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50).alias("node"), "id"), "rows")
        nodes = save(spark.range(50).withColumnRenamed("id", "node"), "nodes")
        at = save(together(rows.join(nodes, "node", "left_semi"), ["node"], ["node", "id"]).withColumn("task", F.spark_partition_id()), "at")
        assert at.groupBy("node").agg(F.count_distinct("task").alias("tasks")).where("tasks > 1").count() == 0 and at.count() == 40_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_language_on_held_out_rows(spark):
    found = entries.op7_langid(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_texts(docs):
    got = {r.text: r for r in langid.identify(docs, langid.learn(docs)).collect()}
    assert [got[t].lang_pred for t in (None, "", " ")] == ["und"] * 3
    assert set(got["x"].asDict()) == {*docs.columns, "lang_pred"}
    model = langid.Model(["de", "en"], {"two": 0}, np.array([[-1.0, 1.0]]), {"_": 0}, np.array([[0.5, -0.5]]))
    assert [model.predict(t)[0] for t in ("½ ² 12 Ⅷ", "two²", "²")] == ["und", "en", "und"]


def test_personal_data_base_equals_plain(spark):
    rules = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def good(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "card":
            return 12 <= len(d) <= 19 and sum((int(c) * (1 + i % 2) - 1) % 9 + 1 if int(c) else 0 for i, c in enumerate(reversed(d))) % 10 == 0
        return all(int(x) <= 255 for x in m.split(".")) if kind == "ip" else 9 <= len(d) <= 15 if kind == "phone" else True

    r = random.Random(3)
    texts = ["".join(r.choice("a1234567890@.+- (é") for _ in range(r.randrange(60))) for _ in range(300)] + ["a@b.c_d@e.f", "é a@b.c 4111 1111 1111 1111 " * 700, "4111 1111-1111 1111", "é +1 (376) 555-9077", "9" * 9000, None, "", "a@b.c" * 30, "x" * 70000, "a@b" + ".c" * 60000 + "-", "1.2" * 30000, "+1" + " 2" * 30000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for row in pii.find_personal_data(df).collect():
        expected = sorted((m.start(), i, m.end(), k) for i, (k, p) in enumerate(rules.items()) for m in re.finditer(p, texts[row.doc_id] or "") if good(k, m[0]))
        assert [tuple(s)[:4] for s in row.spans if s.base] == expected, texts[row.doc_id]


def _odd_spans():
    r = random.Random(6)
    draw = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    digit = lambda n: draw("0123456789", n)
    texts = []
    for i in range(40):
        texts += [f'then token = "{draw("0123456789abcdef", 40)}" and', f"and password={draw('0123456789abcdef', 18)} on", f"here AKIA{draw('ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789', 16)}1A there", f"his ssn: {r.randrange(100, 600)}-{r.randrange(10, 99)}-{r.randrange(1000, 9999)}."]
        texts += [f"call (20{r.randrange(2, 9)}) 555-{digit(4)} now", f"part 1{digit(2)}.{digit(3)} {digit(4)} and", f"order {digit(3)}-{digit(2)}-{digit(4)}", f"see chapter-{i}-part-{digit(2)} or utf-8-variant-{i}", f"born on {r.randrange(1, 28)}.{r.randrange(1, 12)}.19{digit(2)} there", f"published {digit(2)}.{digit(2)}.{digit(4)}", f"invoice {digit(10)} was", f"account {digit(11)} is"]
    texts += ["IBAN DE89 3704 0044 0532 0130 00 please", "GB82WEST12345698765432", "XX12 0000 0000 0000 0000", "DE89 3704 0044 0532 0130 01", "IT60X0542811101000000123456", "write to a.b (at) site (dot) org", None, "", "x" * 50000 + "1", "9" * 30, "ab-" * 9000 + "7"]
    return texts


def test_personal_data_the_method_adds_equals_plain(spark):
    import regex

    texts = _odd_spans()
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, more int")
    got = {r.doc_id: [tuple(s)[:4] for s in r.spans if not s.base] for r in pii.find_personal_data(rows).collect()}
    base = {r.doc_id: [(s.start, s.end) for s in r.spans if s.base] for r in pii.find_personal_data(rows).collect()}

    def has(pattern, x):
        return regex.search(pattern, x) is not None

    def iban(m):
        m = m.replace(" ", "")
        return int("".join(str(int(c, 36)) for c in m[4:] + m[:4])) % 97 == 1

    found = []
    for i, t in enumerate(texts):
        own = []
        for kind, pattern in pii.CANDIDATES.items():
            last = 0
            for m in regex.finditer(pattern, t or ""):
                lead, x = (t[last : m.start()])[-40:], m[0]
                last = m.end()
                word = lambda w: has(rf"(?i)(?<![\p{{L}}\p{{N}}])(?:{w})(?![\p{{L}}\p{{N}}])[^\n]{{0,20}}$", lead)  # noqa: B023, E731
                say = lambda yes, no: 1 if yes else -1 if no else 0
                turns, distinct = len(regex.findall("[A-Za-z]+|[0-9]+|[^A-Za-z0-9]", x)), len(set(regex.sub("[^0-9]", "", x)))
                shape = (1 if iban(x) else -1) if kind == "iban" else say(has(pii.SHAPE_FOR[kind], x) and not has(pii.SHAPE_AGAINST[kind], x), has(pii.SHAPE_AGAINST[kind], x))
                votes = (shape, say(has(pii.KNOWN_FOR[kind], x) and not has(pii.KNOWN_AGAINST[kind], x), has(pii.KNOWN_AGAINST[kind], x)), say(word(pii.WORDS_FOR[kind]), word(pii.WORDS_AGAINST)), say(has(pii.MARKS_FOR, lead), has(pii.MARKS_AGAINST, lead)), say(turns >= 4, turns <= 2) if kind == "secret" else -1 if distinct <= 2 else 0)
                n, end = len(x), lead[-1:]
                before = "start" if not end else ("mark" if lead[-2:-1] in ("=", ":") and lead[-2:-1] else "space") if end.isspace() else "mark" if end in "=:" else "quote" if end in "\"'" else "other"
                seen = (kind, str(0 if n < 12 else 1 if n < 18 else 2 if n < 32 else 3), str(int(3.999 * sum(c.isdigit() for c in x) / n)), str(int(3.999 * sum("A" <= c <= "Z" for c in x) / n)), before, {1: "for", -1: "against", 0: "none"}[votes[2]])
                own.append((m.start(), m.end(), kind, votes, seen))
        order = list(pii.CANDIDATES)
        meets = lambda a, b: a[0] < b[1] and b[0] < a[1]
        free = [c for c in own if not any(meets(c, b) for b in base[i])]
        found += [(i, *c) for c in free if not any(meets(c, b) and order.index(b[2]) < order.index(c[2]) for b in free)]
    kinds, votes = np.array([c[3] for c in found]), np.array([c[4] for c in found])
    start = np.array([[0.05, 0.45], [0.35, 0.45], [0.6, 0.1]])  # by vote -1, 0, 1: on true and on false spans
    chance, prior = np.repeat(start[None], 5, 0), dict.fromkeys(set(kinds), 0.3)
    for _ in range(pii.ROUNDS):
        share = np.array([prior[k] for k in kinds])
        like = np.array([share, 1 - share]).T * np.prod([chance[j][votes[:, j] + 1] for j in range(5)], 0)
        post = like[:, 0] / like.sum(1)
        prior = {k: (post[kinds == k].sum() + 3) / ((kinds == k).sum() + 10) for k in prior}
        for j in range(5):
            mass = 10 * start + np.array([[post[votes[:, j] == v].sum(), (1 - post)[votes[:, j] == v].sum()] for v in (-1, 0, 1)])
            chance[j] = mass / mass.sum(0)
    names = sorted({(i, v) for c in found for i, v in enumerate(c[5])})
    x = np.array([[float(c[5][i] == v) for i, v in names] for c in found])
    w = np.zeros(len(names))
    for _ in range(100):  # full Newton steps
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (p - post) + 0.1 * w)
    scores = 1 / (1 + np.exp(-x @ w))
    expected = {i: sorted((c[1], pii.SPAN_KINDS.index(c[3]), c[2], c[3]) for c, s in zip(found, scores, strict=True) if c[0] == i and s >= pii.THRESHOLD) for i in range(len(texts))}
    assert got == expected
    added = {k for spans in got.values() for *_, k in spans}
    assert {"secret", "ssn", "phone", "iban", "email"} <= added
    for i in range(40):  # every planted secret and number, and none of the decoys
        own = [[s[3] for s in got[12 * i + j]] for j in range(12)]
        assert own[:4] == [["secret"], ["secret"], ["secret"], ["ssn"]] and not any(own[j] for j in (7, 9, 10))


def test_reliabilities_are_estimated(spark):
    """Labelers of known reliability vote on spans of known truth; EM, told neither, finds both."""
    r, counts, truth = random.Random(2), {}, {}
    good = [(0.9, 0.05), (0.7, 0.1), (0.5, 0.3)]
    for _ in range(4000):
        y = r.random() < 0.4
        votes = []
        for hit, miss in good:
            u = r.random()
            votes.append(1 if u < (hit if y else miss) else -1 if u > (1 - miss if y else 1 - hit) else 0)
        p = ("k", *votes)
        counts[p] = counts.get(p, 0) + 1
        truth[p] = truth.get(p, 0) + y
    post, chance = pii.expectation_maximisation(counts)
    for j, (hit, miss) in enumerate(good):
        assert abs(chance[j][0][1] - hit) < 0.08 and abs(chance[j][1][1] - miss) < 0.08
    right = sum(max(truth[p], n - truth[p]) if (post[p] > 0.5) == (2 * truth[p] > n) else n - max(truth[p], n - truth[p]) for p, n in counts.items())
    assert right > 0.9 * 4000


@pytest.mark.parametrize(("most", "shift"), [(40_000, 0), (3, 1 << 40)])
def test_passages_equal_plain(docs, monkeypatch, most, shift):
    if shift:  # ids of more than 32 bits, and shards of several automata
        docs = docs.withColumn("doc_id", F.col("doc_id") + shift)
    rows = [(r.doc_id, (r.text or "").encode().split()) for r in docs.collect()]
    first = {}
    for i, w in rows:
        for k in range(len(w) - 12):
            if i is not None:
                first[tuple(w[k : k + 13])] = min(i, first.get(tuple(w[k : k + 13]), i))
    expected = []
    for i, w in rows:
        gone = {j for k in range(len(w) - 12) if i is not None and first[tuple(w[k : k + 13])] < i for j in range(k, k + 13)}
        expected.append((i, b" ".join(x for j, x in enumerate(w) if j not in gone).decode(), len(w), len(gone)))
    assert sum(e[3] for e in expected) > 50
    parts = phrases.automaton_parts
    monkeypatch.setattr(phrases, "automaton_parts", lambda entries, window: parts(entries, window, most))
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in phrases.remove_repeated_passages(docs).collect())


def test_the_automata_alone_decide_which_passages_go():
    import ahocorasick
    import pyarrow as pa

    h = np.random.default_rng(4).integers(0, 1 << 63, 60).astype(np.uint64)
    entries = pa.table({"shard": [0, 0], "passage": [h[:20].tobytes(), h[30:43].tobytes()], "first": [1 << 40, 9]})
    text = np.concatenate((h[25:29], h[:13], h[50:], h[30:43], h[2:20]))
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "t": {"x": 1, "y": 1}, "start": 100, "words": text.tobytes()} for i in (1 << 50, 10, 9)])
    for most in (1, 3, 100):
        found = [[], [], []]
        for part in phrases.automaton_parts(entries, 13, most):
            compiled = phrases.compile_passages(*part, 13)
            for own, spans in zip(found, phrases.occurrences(batch, compiled, 13).column("spans").to_pylist(), strict=True):
                own += [range(s["a"], s["b"]) for s in spans]
            blind = ahocorasick.Automaton(ahocorasick.STORE_INTS)
            blind.add_word("no such key", 0)
            blind.make_automaton()
            assert not any(phrases.occurrences(batch, (blind, *compiled[1:]), 13).column("spans").to_pylist())
        assert [{i for s in own for i in s} for own in found] == [{*range(104, 117), *range(127, 158)}, set(range(127, 140)), set()]


@pytest.mark.parametrize("shard_keys", [1 << 16, 5])
def test_lines_equal_plain(docs, shard_keys):
    rows = docs.collect()
    keys = lambda t: [x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)}) for x in (t or "").split("\n")]
    held = {}
    for r in rows:
        for k in set(keys(r.text)):
            held.setdefault(k, set()).add(-(2**63) if r.doc_id is None else r.doc_id)
    expected = []
    for r in rows:
        own = (r.text or "").split("\n")
        kept = [x for x, k in zip(own, keys(r.text), strict=True) if len(k) < 20 or len(held[k]) < 3 or max(held[k]) == r.doc_id]
        expected.append((r.doc_id, "\n".join(kept), len(own), len(own) - len(kept)))
    got = lines.drop_repeated_lines(docs, shard_keys=shard_keys).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sum(e[3] for e in expected) == 3
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)) for r in got)


def test_documents_probe_counts_of_all_lines(spark):
    """The index holds every distinct line, rare ones too, and its counts alone tell which are frequent."""
    texts = [f"a line of document {i // 2} here\nthe line that is in all\nthe line that is in all" for i in range(12)]
    keys = spark.createDataFrame([(i, *h) for i, t in enumerate(texts) for h in {lines.line_hash(x.encode(), 20) for x in t.split("\n")}], "doc_id long, h1 long, h2 long")
    index, shards = lines.build_index(keys, 3, 2)
    rows, seen = {r.shard: r for r in index.collect()}, 0
    assert shards == 4 and sum(len(r.counts) for r in rows.values()) == 4 * 7
    for line, count, last in [("the line that is in all", 12, 11), *((f"a line of document {i} here", 2, 0) for i in range(6)), ("a line nobody has at all", 0, 0)]:
        h1, h2 = (np.array([x], np.int64) for x in lines.line_hash(line.encode(), 20))
        if r := rows.get(int(h1[0] % shards)):
            got = lines.Shard(r.mph, r.prints, r.counts, r["last"], 3).probe(h1, h2)
            assert (got[0][0], got[1][0]) == (count, last)
            seen += 1
    assert seen >= 7


def test_perfect_hash_is_minimal_and_survives_storage():
    h = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, (2, 5000))
    mph = lines.PerfectHash.load(lines.PerfectHash(h[0], h[1]).dump())
    assert sorted(mph.index(h[0], h[1])) == list(range(5000))


def test_pipeline_keeps_columns_and_clean_documents(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        out.write.parquet(path := scratch_path(spark, name))
        after = spark.read.parquet(path)
        assert 0 < after.count() <= docs.count()
        docs = after
    near = chosen_path.near_duplicates(docs)
    assert near.where("doc_id <> component_id").count() == 0
    assert not winnow.contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").count()
    whole = p.run(spark, SF)
    assert 0 < whole.count() <= docs.count()
    assert whole.agg(F.max(F.col("taken") - 3 * F.col("size"))).first()[0] <= 0


def test_trees_meet_the_recall_with_coordinates_of_their_own():
    for percent in (50, 80, 85, 95):
        trees, need = chosen_path.plan(0.99999, percent)
        assert chosen_path.tree_miss(percent) ** trees + chosen_path.sketch_miss(need, percent) <= 1e-5
        paths = chosen_path.tree_paths(trees)
        steps = {p[:i] + (c,) for p in paths for i, c in enumerate(p)}
        assert len({s[-1] for s in steps}) == len(steps)


def test_near_duplicates_in_large_nodes_are_all_found(spark, monkeypatch):
    """Pairs just above the threshold, all of whose documents share most of their words, so that nodes are far larger than a crowd."""
    r, rows = random.Random(8), []
    shared = [f"w{i}" for i in range(150)]
    for i in range(150):
        own = [f"p{i}x{j}" for j in range(50)]
        rows += [(2 * i, " ".join(shared + own)), (2 * i + 1, " ".join(shared + own[: r.randrange(30, 36)] + [f"q{i}x{j}" for j in range(15)]))]
    sets = [{tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for _, t in rows]
    linked = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    assert not any(linked(a, b) for a in range(300) for b in range(a) if a // 2 != b // 2)
    expected = {(a, a - a % 2 if linked(a - a % 2, a - a % 2 + 1) else a) for a in range(300)}
    monkeypatch.setattr(chosen_path, "CROWD", 16)
    assert {(x.doc_id, x.component_id) for x in chosen_path.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == expected


def test_language_without_evidence_and_with_one_learned_language(spark):
    import corpus_pipeline as p

    rows = [(i, f"plain words number {WORDS[i % 15]} again", "en", 7) for i in range(40)] + [(100, None, "en", 7), (101, "12 ½", "en", 7), (102, "пример", None, 7)]
    one = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(one, langid.learn(one)).collect()}
    assert got == {i: ("und", 0.0) if i in (100, 101) else ("en", 1.0) for i, *_ in rows}
    assert {r.doc_id for r in p.language(spark, one, SF).collect()} == {i for i, *_ in rows} - {100, 101}
    two = one.union(spark.createDataFrame([(200 + i, f"einfache woerter {WORDS[i % 15]} wieder", "de", 7) for i in range(12)], one.schema))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(two, langid.learn(two)).collect()}
    assert got[102][0] == "en" and 0 < got[102][1] < 0.5
    kept = {r.doc_id for r in p.language(spark, two, SF).collect()}
    assert 102 not in kept and len(kept) == 52


def test_members_of_many_records_are_salvaged():
    made = [warc.record("response", f"urn:page:{i}", "http://x", hashlib.sha256(p).hexdigest(), p, len(p), None) for i, p in enumerate(random.Random(i).randbytes(3000) for i in range(6))]
    ids = lambda data: [r["record_id"][9:] for _, _, _, x in warc.salvage(data) for r in x]
    gaps = lambda data: [(s, e, why) for s, e, why, _ in warc.salvage(data) if why]
    joined = b"".join(made)
    bad = warc.member(joined.replace(made[2], made[2][:-9] + b"?" * 5 + made[2][-4:]))
    assert ids(bad + warc.member(made[5])) == ["0", "1", "3", "4", "5", "5"]
    assert [(s, e) for s, e, _ in gaps(bad)] == [(0, len(bad) - bad.endswith(warc._EMPTY_MEMBER) * len(warc._EMPTY_MEMBER))]
    whole = warc.member(joined)
    cut = whole[: len(whole) * 7 // 10]
    assert ids(cut) == ["0", "1", "2", "3"] and [(e, why) for _, e, why in gaps(cut)] == [(len(cut), "gzip: truncated")]
    hurt = whole[: len(whole) // 2] + b"\xff" * 4000
    assert ids(hurt + warc.member(made[5]) + made[4]) == ["0", "1", "5", "4"]
    c = zlib.compressobj(0, zlib.DEFLATED, 31)  # records in the clear are not found twice
    clear = c.compress(joined) + c.flush()
    assert ids(clear[:-4]) == list("012345")


def test_a_page_with_a_very_long_url_is_read_back(spark):
    url = "data:text/html," + "x" * 200_000
    warc.write_archives(spark.createDataFrame([(1, url, "<p>a"), (2, "u", "b")], "page_id long, url string, html string"), path := scratch_path(spark, "long"))
    assert {(r.kind, r.record_id, r.target_uri) for r in warc.read_archives(spark, path).collect()} == {("record", "urn:page:1", url), ("record", "urn:page:2", "u")}


def test_decontamination_judges_each_row(spark, tmp_path):
    import corpus_pipeline as p

    passage = " ".join(f"item{i}" for i in range(20))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"before {passage} after", 1), (None, "clean text", 2), (5, passage, 3), (5, "clean too", 4), (6, None, 5)]
    left = p.decontaminate(spark, spark.createDataFrame(rows, "doc_id long, text string, n_chars long"), str(tmp_path)).collect()
    assert {tuple(r) for r in left} == {rows[1], rows[3], rows[4]} and len(left) == 3


def test_language_of_a_long_run_is_told_by_all_of_it():
    model = langid.Model(["de", "en"], {}, np.zeros((0, 2)), {"a": 0, "b": 1}, np.array([[0.5, -0.5], [-0.5, 0.5]]))
    assert [model.predict(t)[0] for t in ("a" * 64, "a" * 64 + "b" * 200)] == ["de", "en"]


def test_language_learns_from_all_of_a_long_run(spark):
    rows = [(1, "a" * 64 + "b" * 300, "de"), (3, "a" * 64 + "c" * 300, "en")]
    rows = [(i, t, x) for k in range(40) for i, t, x in [(100 * k + j, t, x) for j, t, x in rows] if zlib.crc32(str(i).encode()) % 4 != 2]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.words == {} and model.grams.keys() >= {"bbbbb", "ccccc", "aabbb", "b", "c_"}
    assert [model.predict(t)[0] for t in ("bbb", "ccc", "a" * 64 + "b" * 90, "c" * 500)] == ["de", "en", "de", "en"]


def test_language_model_equals_plain_counts(spark):
    from collections import Counter

    r = random.Random(12)
    words = ["".join(r.choice("abcäж") for _ in range(r.choice((1, 3, 6, 9, 80)))) for _ in range(120)]
    rows = spark.createDataFrame([(r.choice(("de", "en")), w, i + 1) for i, w in enumerate(words)], "lang string, word string, n long")
    expected = Counter()
    for lang, word, n in rows.collect():
        for size in range(1, langid.LONGEST + 1):
            for i in range(len(word) + 3 - size):
                expected[size, f"_{word}_"[i : i + size], lang] += n
    old, langid.FLUSH = langid.FLUSH, 50
    try:
        assert {(x["size"], x.gram, x.lang): x.n for x in langid.gram_counts(rows).collect()} == expected
    finally:
        langid.FLUSH = old


def test_spans_of_a_long_text_are_compared_in_blocks(spark):
    r = random.Random(21)
    span = lambda k, wide: (a := r.randrange(4000), a + r.randrange(1, wide), k)
    rows = [([span(r.choice("ab"), 30) for _ in range(n)], [span("b", 12) for _ in range(m)]) for n, m in ((0, 0), (0, 5), (5, 0), (1, 1), (60, 70), (300, 90), (90, 300))]
    kind = "array<struct<start:int,end:int,kind:string>>"
    got = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], f"i int, x {kind}, y {kind}").select("i", pii.without(F.col("x"), F.col("y")).alias("free"), pii.without(F.col("x"), F.col("x"), lambda a, b: a["kind"] < b["kind"]).alias("first")).collect()
    touch = lambda a, b: a[0] < b[1] and b[0] < a[1]
    for row in got:
        x, y = rows[row.i]
        assert [tuple(s) for s in row.free] == [s for s in x if not any(touch(s, o) for o in y)]
        assert [tuple(s) for s in row.first] == [s for s in x if not any(touch(s, o) and o[2] < s[2] for o in x)]


def test_personal_data_in_a_text_of_many_spans(spark):
    text = " ".join(f"token = \"{i:08x}{i * 7:08x}{i * 13:08x}\" x{i}@b.org" for i in range(20000))
    start = time.time()
    row = pii.find_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string")).select(F.size(F.filter("spans", lambda s: s["kind"] == "email")).alias("email"), F.size(F.filter("spans", lambda s: s["kind"] == "secret")).alias("secret")).first()
    assert row.email == 20000 and row.secret > 19000 and time.time() - start < 100
