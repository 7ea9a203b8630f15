"""The pipeline's rows, and each stage's, against plain versions of the five stages; odd tables through every stage."""

from __future__ import annotations

import hashlib
import random
import re
import unicodedata

import numpy as np
import pytest

import corpus_pipeline as p
from tessel.llm import langid
from tessel.llm.common import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EN, DE = "the house and garden were quiet when morning came over hills".split(), "das haus und der garten waren still als morgen kam über berge".split()
WORD, LINE_SPACE = re.compile(r"[^ \t-\r]+"), " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def rows_and_items() -> tuple[list[tuple], list[tuple]]:
    r = random.Random(12)
    say = lambda words, n: " ".join(r.choice(words) + r.choice(["", "s", "en", "ly"]) for _ in range(n))
    item, short, line = say(EN, 30), "Quiet morning-garden!", "Subscribe to our letters today"
    texts = [(say(EN, 60), "en") for _ in range(30)] + [(say(DE, 50), "de") for _ in range(20)]
    base = say(EN, 200).split()
    texts += [(" ".join(base[:i] + ["changed"] + base[i + 1 :]), "en") for i in range(0, 60, 10)] + [(" ".join(base), None)] * 2
    texts += [(f"{say(EN, 20)}\n {line.upper()} \n{say(EN, 20)}", "en") for _ in range(5)] + [(line, "en"), (f"{line}\n\t", "en")]
    texts += [(f"{say(EN, 12)} {' '.join(item.split()[4:16])}, {say(EN, 12)}", "en"), (f"{say(DE, 12)} quiet MORNING garden {say(DE, 12)}", "de"), (item, "en")]
    texts += [(None, "en"), ("", None), ("12 34", "en"), ("你好世界", None), ("\n\n", "de"), ("x " * 3000, "en")]
    rows = [(7 * i + 1, t, lang, ["a", "b", None, "a", "c"][i % 5], len(t or "")) for i, (t, lang) in enumerate(texts)]
    rows += [rows[3], (None, texts[0][0], "en", "a", 5), (None, item, "en", "b", 6), (None, None, None, None, None)]
    return rows, [(1, item), (2, short), (3, None), (None, say(EN, 15)), (4, "--")]


def plain_language(rows, model):
    def weigh(run):
        if run in model.words:
            return model.word_scores[model.words[run]].astype(float)
        padded, found = f"_{run}_", []

        def back_off(a, b):
            if padded[a:b] in model.grams:
                found.append(padded[a:b])
            elif b - a > 1:
                back_off(a, b - 1)
                if a == 0 or b == len(padded):
                    back_off(a + 1, b)

        size = min(langid.LONGEST, len(padded))
        for a in range(len(padded) - size + 1):
            back_off(a, a + size)
        if not set(found) - {"_"}:
            return np.zeros(len(model.langs))
        return np.mean([model.gram_scores[model.grams[g]] for g in found], axis=0)

    out = []
    for row in rows:
        low = (row[1] or "").lower()
        runs = "".join(c if unicodedata.category(c).startswith("L") else " " for c in low).split()
        total = np.sum([weigh(x) for x in runs], axis=0) if runs else None
        if total is None:
            continue
        if not total.any():
            if min(langid.NO_EVIDENCE, model.prior.max()) >= p.MIN_SCORE:
                out.append(row)
            continue
        share = np.exp(total - total.max())
        if share.max() / share.sum() >= p.MIN_SCORE:
            out.append(row)
    return out


def plain_lines(rows):
    key = lambda x: x.strip(LINE_SPACE).translate(LOWER)
    held: dict[str, set] = {}
    for r in rows:
        for x in (r[1] or "").split("\n"):
            held.setdefault(key(x), set()).add(-(2**63) if r[0] is None else r[0])
    out = []
    for r in rows:
        own = (r[1] or "").split("\n")
        kept = [x for x in own if len(key(x)) < 20 or len(held[key(x)]) < 3 or max(held[key(x)]) == r[0]]
        text = "\n".join(kept)
        if len(kept) == len(own):
            out.append((r[0], text, *r[2:]))
        elif WORD.search(text):
            out.append((r[0], text, r[2], r[3], len(text)))
    return out


def plain_near(rows):
    sets = []
    for r in rows:
        w = WORD.findall((r[1] or "").translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    gone = set()
    for g in set(group):
        ids = [r[0] for r, x in zip(rows, group, strict=True) if x == g and r[0] is not None]
        gone |= {i for i in ids if i != min(ids)}
    return [r for r in rows if r[0] is None or r[0] not in gone]


def plain_clean(rows, items):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    wanted = {tuple(v[i : i + min(10, len(v))]) for _, t in items for v in [words(t)] if v for i in range(len(v) - min(10, len(v)) + 1)}
    return [r for r in rows if not any(tuple(w[i : i + m]) in wanted for w in [words(r[1])] for m in {len(x) for x in wanted} for i in range(len(w) - m + 1))]


def plain_mix(rows):
    sizes = [len(WORD.findall(r[1] or "")) for r in rows]
    sources = sorted({r[3] for r in rows if r[3] is not None}) + [None] * any(r[3] is None for r in rows)
    have = {s: sum(n for r, n in zip(rows, sizes, strict=True) if r[3] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    capped: set = set()
    while True:  # clamp, share the rest by weight, until none is above
        left = sum(have.values()) - sum(3 * have[s] for s in capped)
        per = left / sum(weight[s] for s in sources if s not in capped)
        over = {s for s in sources if s not in capped and per * weight[s] >= 3 * have[s]}
        if not over:
            break
        capped |= over
    target = {s: 3.0 * have[s] if s in capped else per * weight[s] for s in sources}
    out = []
    for s in sources:
        own = sorted(((hashlib.md5(f"mix-1|{'null' if r[0] is None else r[0]}".encode()).hexdigest(), n, r) for r, n in zip(rows, sizes, strict=True) if r[3] == s), key=lambda x: x[:2])
        goal = int(np.floor(target[s] + 0.5))
        whole, rest = divmod(goal, have[s]) if have[s] else (0, 0)
        for _, n, r in own:
            more = max(0, min(n, rest))
            rest -= more
            part = 0 if more == n else more
            taken = whole * n + more
            if taken or not n:
                out.append((*r, n, have[s], target[s], taken, whole + (more == n), " ".join(WORD.findall(r[1] or "")[:part])))
    return out


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    folder, (rows, items) = str(tmp_path_factory.mktemp("table")), rows_and_items()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def near(rows):
    return sorted(repr(tuple(round(x, 6) if isinstance(x, float) else x for x in r)) for r in rows)


def test_every_stage_and_the_run_equal_plain_versions(spark, table):
    folder, rows, items = table
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = langid.learn(docs)
    plain = {"language": lambda x: plain_language(x, model), "line_dedup": plain_lines, "near_dedup": plain_near, "decontaminate": lambda x: plain_clean(x, items), "mix": plain_mix}
    sizes = [len(rows)]
    for name, stage in p.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(path := scratch_path(spark, name))
        docs = spark.read.schema(out.schema).parquet(path)
        rows = plain[name](rows)
        sizes.append(len(rows))
        assert near(docs.collect()) == near(rows), name
    assert sorted(set(sizes[:5]), reverse=True) == sizes[:5]  # each filter drops something
    assert near(p.run(spark, folder).collect()) == near(rows)


@pytest.mark.parametrize("case", ["empty", "clashing", "nulls"])
def test_odd_tables_go_through_every_stage(spark, table, case):
    from pyspark.sql import functions as F

    folder, docs = table[0], spark.read.parquet(f"{table[0]}/documents.parquet")
    own = ("score", "lang_pred", "n_lines", "n_dropped", "size", "taken", "target", "fp", "_row", "part", "node", "t1", "shard", "w")
    if case == "empty":
        docs = docs.limit(0)
    elif case == "nulls":
        docs = docs.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema))
    for c in own if case == "clashing" else ():
        docs = docs.withColumn(c, F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    for name, stage in p.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(path := scratch_path(spark, name))
        after = spark.read.schema(out.schema).parquet(path)
        assert name == "mix" or after.columns == docs.columns
        got = after.collect()
        assert (len(got) > 20) == (case == "clashing")
        for r in got:
            assert all(r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}" for c in (own if case == "clashing" else ()))
        docs = after
    assert {"size", "taken", "repetitions", "part_text"} - set(own if case == "clashing" else ()) <= set(docs.columns)


def test_a_stage_deletes_only_what_stages_saved(spark, table):
    from tessel.llm.common import save

    docs = spark.read.parquet(f"{table[0]}/documents.parquet")
    other = save(docs, "of another owner")
    p.mix(spark, docs, table[0]).collect()
    assert p.mix(spark, docs, table[0]).count() and other.count() == len(table[1])
