"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, and a span classifier decides."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessel.llm.common import discard, save

#: The base kinds in their order. The patterns accept what the plain ones do, but never look
#: at a run of characters twice: a run whose first place fails fails at its later places too.
BASE = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", "."),
    "card": (r"[0-9](?:[ -]?+[0-9])++", ""),
    "phone": (r"\+[0-9][ ().0-9-]+[0-9]", "+"),
}
KINDS = tuple(BASE)
#: Candidates of the method beyond the base kinds, wide enough to hold what is no personal data too.
CANDIDATES = {
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9]|[.-][0-9])",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]{1,63} ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z]{2,10}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|[.-][0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "birth": r"(?<![0-9./-])(?:[0-9]{1,2}([./-])[0-9]{1,2}\1[0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9]|[./-][0-9])",
    "account": r"(?<![A-Za-z0-9.+/_-])[0-9]{8,20}+(?![A-Za-z0-9.+/_-])",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{12,}+",
}
SPAN_KINDS = (*KINDS, "ssn", "iban", "birth", "account", "secret")
#: What a text must hold to be searched for candidates of a kind; implied by its pattern.
GATES = {"email": r"\(at\)|\[at\]", "secret": "[0-9]", "iban": "[A-Z]{2}[0-9]{2}"}
#: Fixed values of the regex labeler: the strict shape of a kind, and what contradicts it.
SHAPE_FOR = {
    "phone": r"^\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}$|^[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}$", "email": r"[A-Za-z0-9]$", "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)", "iban": "",
    "birth": "^$", "account": "^$", "secret": r"^(?:[0-9a-f]{16,}|[0-9A-F]{16,}|[A-Z0-9]{16,})$|^(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9]).{20,}$",
}
SHAPE_AGAINST = {
    "phone": r"^\(?[01]", "email": "^$", "ssn": r"^(?:000|666|9)|-00-|-0000$", "iban": "", "birth": r"^(?:00?|3[2-9]|[4-9][0-9])[./-]|[./-](?:00?|1[3-9]|[2-9][0-9])[./-]|[./-](?!19|20)[0-9]{4}$|^(?!19|20)[0-9]{4}-",
    "account": r"^(?:[0-9]{8,9}|[0-9]{19,})$", "secret": r"^[A-Za-z]+[-_/][A-Za-z0-9/_-]+$|^[A-Za-z]+[0-9]{1,4}$",
}
#: Fixed values of the gazetteer labeler: known codes, countries, providers and prefixes, and well-known samples.
KNOWN_FOR = {
    "phone": r"^\(?[2-9](?!11)[0-9]{2}", "email": r"(?i)(?:com|org|net|edu|io|de|fr|es|uk)$", "ssn": "^$", "iban": r"^(?:AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE)", "birth": "^$", "account": "^$",
    "secret": r"^(?:AKIA|ASIA|AIza|gh[pousr]_|github_pat_|glpat-|sk-|xox[abp]-|eyJ)",
}
KNOWN_AGAINST = {"phone": r"^\(?[0-9]11", "email": "^$", "ssn": r"^(?:078-05-1120|219-09-9999)$", "iban": r"^(?:ID|NO|NR|VS|XX)[0-9]", "birth": "^$", "account": r"^(?:0+|12345678.*|(.)\1+)$", "secret": r"(?i)^(?:utf-?|iso-?|x86|covid|version|chapter)"}
#: Fixed values of the context labelers: words that speak for a kind or against it within the lead, and marks right before it.
WORDS_FOR = {
    "phone": r"tel|telephone|phone|mobile|cell|call|fax|telefon|móvil", "email": r"mail|e-mail|contact|write to|correo|courriel", "ssn": r"ssn|social security|social", "iban": r"iban|account|konto|compte|cuenta",
    "birth": r"born|birth|birthday|dob|geboren|née?|nacid[oa]", "account": r"account|acct|konto|compte|cuenta|passport|licen[cs]e|customer", "secret": r"password|passwd|pwd|pass|token|secret|key|api_?key|auth|bearer|credentials?",
}
WORDS_AGAINST = r"order|invoice|isbn|issn|doi|version|part|serial|item|page|chapter|figure|table|sha1|sha256|md5|checksum|commit|uuid|published|updated"
MARKS_FOR, MARKS_AGAINST = r"[=:] ?[\"']?$", r"[#$%/\\*~^]$"
LABELERS = ("shape", "known", "words", "marks", "spread")
CONTEXT, ROUNDS, THRESHOLD = 40, 50, 0.5


def matches(text: Column, pattern: str, context: int = 0) -> Column:
    """array<struct<start, end, m, lead>> in code points, from what lies between and within the matches; lead is what comes before, back to the match before, of ``context`` at most.

    Places are summed within blocks of about the square root of the number of matches and then over the
    blocks, so that the list found so far is not copied once for each match.
    """
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    empty = F.expr("named_struct('at', 0, 'out', cast(array() as array<struct<start:int,end:int,m:string,lead:string>>))")
    no_blocks = F.expr("named_struct('at', 0, 'out', cast(array() as array<array<struct<start:int,end:int,m:string,lead:string>>>))")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        more = F.when(x["m"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("m"), (F.right(x["gap"], F.lit(context)) if context else F.lit("")).alias("lead")))))
        return F.struct(end.alias("at"), more.alias("out"))

    def blocks(p: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(p))).cast("int")
        last = F.floor((F.size(p) - 1) / width).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.aggregate(F.slice(p, i * width + 1, width), empty, step))

    def join(acc: Column, block: Column) -> Column:
        moved = F.transform(block["out"], lambda x: F.struct((acc["at"] + x["start"]).alias("start"), (acc["at"] + x["end"]).alias("end"), x["m"].alias("m"), x["lead"].alias("lead")))
        return F.struct((acc["at"] + block["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    bound = F.transform(F.array(parts), lambda p: F.aggregate(blocks(p), no_blocks, join, lambda acc: F.flatten(acc["out"])))  # parts are made once
    return F.element_at(bound, 1)


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    d = F.reverse(digits(m))

    def weigh(i: Column) -> Column:
        x = F.substring(d, i, F.lit(1)).cast("int") * (2 - i % 2)
        return F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda acc, i: acc + weigh(i)) % 10 == 0


def passes(kind: str, m: Column) -> Column:
    n = F.length(digits(m))
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.right(p, F.lit(3)).cast("int") <= 255))
    if kind == "card":
        return n.between(12, 19) & luhn(m)
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def _none() -> Column:
    return F.expr("cast(array() as array<struct<start:int,end:int,m:string,lead:string>>)")


def base_spans(text: Column, kind: str) -> Column:
    pattern, needs = BASE[kind]
    present = F.contains(text, F.lit(needs)) if needs else F.lit(True)
    if kind != "email":
        present = present & text.rlike("[0-9]")
    return F.when(present, F.filter(matches(text, pattern), lambda x: passes(kind, x["m"]))).otherwise(_none())


def iban_checks(m: Column) -> Column:
    """Whether the number, its first four characters at the end and letters as 10 to 35, leaves 1 modulo 97."""
    c = F.regexp_replace(m, " ", "")
    turned = F.concat(F.substr(c, F.lit(5)), F.substring(c, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        v = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substring(turned, i, F.lit(1))) - 1
        return (acc * F.when(v > 9, 100).otherwise(10) + v) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def near(lead: Column, words: str) -> Column:
    """Whether one of the words ends at most 20 characters before, in the same line."""
    return lead.rlike(rf"(?i)(?<![\p{{L}}\p{{N}}])(?:{words})(?![\p{{L}}\p{{N}}])[^\n]{{0,20}}$")


def votes(kind: str, m: Column, lead: Column) -> list[Column]:
    """1, -1 or 0 (no opinion) of each of ``LABELERS``: none is implied by the candidate's pattern."""
    says = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    if kind == "iban":
        shape = F.when(iban_checks(m), 1).otherwise(-1)
    else:
        shape = says(m.rlike(SHAPE_FOR[kind]) & ~m.rlike(SHAPE_AGAINST[kind]), m.rlike(SHAPE_AGAINST[kind]))
    turns = F.length(F.regexp_replace(F.regexp_replace(m, "[A-Za-z]+", "a"), "[0-9]+", "0"))
    distinct = F.size(F.array_distinct(F.split(F.regexp_replace(m, "[^0-9]", ""), "")))
    spread = says(turns >= 4, turns <= 2) if kind == "secret" else says(F.lit(False), distinct <= 2)
    return [shape, says(m.rlike(KNOWN_FOR[kind]) & ~m.rlike(KNOWN_AGAINST[kind]), m.rlike(KNOWN_AGAINST[kind])), says(near(lead, WORDS_FOR[kind]), near(lead, WORDS_AGAINST)), says(lead.rlike(MARKS_FOR), lead.rlike(MARKS_AGAINST)), spread]


def features(kind: str, m: Column, lead: Column) -> list[Column]:
    """What the span classifier sees of the text: the kind, and classes of length, shares of digits and capitals, the character before, and cue words before."""
    n = F.length(m)
    share = lambda pattern: F.floor(3.999 * F.length(F.regexp_replace(m, pattern, "")) / n)
    size = F.when(n < 12, 0).when(n < 18, 1).when(n < 32, 2).otherwise(3)
    last = F.right(lead, F.lit(1))
    before = F.when(last == "", "start").when(last.rlike(r"\s"), F.when(lead.rlike(r"[=:]\s$"), "mark").otherwise("space")).when(last.isin("=", ":"), "mark").when(last.isin('"', "'"), "quote").otherwise("other")
    cue = F.when(near(lead, WORDS_FOR[kind]), "for").when(near(lead, WORDS_AGAINST), "against").otherwise("none")
    return [F.lit(kind), size.cast("string"), share("[^0-9]").cast("string"), share("[^A-Z]").cast("string"), before, cue]


def candidate_spans(text: Column) -> Column:
    """array<struct<start, end, kind, votes, features>>, votes and features each as one string."""
    none = F.expr("cast(array() as array<struct<start:int,end:int,kind:string,votes:string,features:string>>)")

    def of(kind: str, pattern: str) -> Column:
        def judged(x: Column) -> Column:
            v = F.concat_ws("|", F.lit(kind), *(c.cast("string") for c in votes(kind, x["m"], x["lead"])))
            return F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind"), v.alias("votes"), F.concat_ws("|", *features(kind, x["m"], x["lead"])).alias("features"))

        return F.when(text.rlike(GATES.get(kind, "[0-9]{4}")), F.transform(matches(text, pattern, CONTEXT), judged)).otherwise(none)

    return F.concat(*(of(k, p) for k, p in CANDIDATES.items()))


def expectation_maximisation(counts: dict[tuple, int], rounds: int = ROUNDS) -> tuple[dict[tuple, float], list[list[dict[int, float]]]]:
    """The probability that a span is personal data for each pattern (kind, votes...), and each labeler's chances of its votes on true and on false spans.

    The chances of each vote and each kind's share of true spans are re-estimated from the expected labels in
    turn; the start, which also weighs as a few spans, trusts each labeler a little. ``counts`` has an entry
    per pattern, at most kinds times three to the number of labelers.
    """
    labelers = range(max((len(p) for p in counts), default=1) - 1)
    start = ({1: 0.6, 0: 0.35, -1: 0.05}, {1: 0.1, 0: 0.45, -1: 0.45})
    chance, prior = [[dict(c) for c in start] for _ in labelers], {p[0]: 0.3 for p in counts}
    post: dict[tuple, float] = {}
    for _ in range(rounds):
        for p in counts:
            odds = math.log(prior[p[0]] / (1 - prior[p[0]])) + sum(math.log(chance[j][0][p[j + 1]] / chance[j][1][p[j + 1]]) for j in labelers)
            post[p] = 1 / (1 + math.exp(max(-700.0, min(700.0, -odds))))
        for k in prior:
            own = [p for p in counts if p[0] == k]
            prior[k] = (sum(counts[p] * post[p] for p in own) + 3) / (sum(counts[p] for p in own) + 10)
        for j in labelers:
            for c in (0, 1):
                mass = {v: 10 * start[c][v] + sum(n * (1 - post[p] if c else post[p]) for p, n in counts.items() if p[j + 1] == v) for v in (1, 0, -1)}
                chance[j][c] = {v: m / sum(mass.values()) for v, m in mass.items()}
    return post, chance


def span_classifier(examples: dict[tuple[str, ...], tuple[float, int]], rounds: int = 200, ridge: float = 0.1) -> dict[tuple[str, ...], float]:
    """Logistic regression on one weight per feature value, by coordinate-wise Newton steps.

    ``examples`` has the expected number of true spans and the number of spans for each tuple of features, as
    many as the classes allow (some thousands) whatever the corpus. Gives each tuple's score.
    """
    weights: dict[tuple[int, str], float] = {}
    holds: dict[tuple[int, str], list[tuple[str, ...]]] = {}
    for f in examples:
        for i, v in enumerate(f):
            holds.setdefault((i, v), []).append(f)
    z = dict.fromkeys(examples, 0.0)
    sigmoid = lambda x: 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))
    for _ in range(rounds):
        moved = 0.0
        for key in sorted(holds):
            w = weights.get(key, 0.0)
            slope, bend = ridge * w, ridge
            for f in holds[key]:
                s = sigmoid(z[f])
                slope += examples[f][1] * s - examples[f][0]
                bend += examples[f][1] * max(s * (1 - s), 0.05)  # short steps where the curve is flat
            step = -slope / bend
            weights[key] = w + step
            moved = max(moved, abs(step))
            for f in holds[key]:
                z[f] += step
        if moved < 1e-9:
            break
    return {f: sigmoid(x) for f, x in z.items()}


def blocks_of(spans: Column) -> Column:
    """Spans sorted by start, cut into about as many blocks as a block has spans: array<struct<lo, hi, items>>."""

    def cut(sorted_spans: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(sorted_spans))).cast("int")

        def block(i: Column) -> Column:
            items = F.slice(sorted_spans, i * width + 1, width)
            return F.transform(F.array(items), lambda x: F.struct(F.element_at(x, 1)["start"].alias("lo"), F.array_max(F.transform(x, lambda y: y["end"])).alias("hi"), x.alias("items")))

        cuts = F.flatten(F.transform(F.sequence(F.lit(0), F.floor((F.size(sorted_spans) - 1) / width).cast("int")), block))
        return F.when(F.size(sorted_spans) > 0, cuts)

    return F.element_at(F.transform(F.array(F.array_sort(spans)), cut), 1)


def without(spans: Column, others: Column, beats: Callable[[Column, Column], Column] | None = None) -> Column:
    """``spans`` less those that touch one of ``others`` (that ``beats`` them, if given).

    A span is compared with the blocks of the others and within those that it touches, so the cost of a
    text grows with the power 1.5 of its spans where few overlap.
    """
    touch = lambda a, lo, hi: (a["start"] < hi) & (lo < a["end"])

    def hit(c: Column, x: Column) -> Column:
        return touch(c, x["start"], x["end"]) & beats(x, c) if beats else touch(c, x["start"], x["end"])

    def free(blocks: Column) -> Column:
        return F.filter(spans, lambda c: ~F.exists(blocks, lambda b: touch(c, b["lo"], b["hi"]) & F.exists(b["items"], lambda x: hit(c, x))))

    bound = F.element_at(F.transform(F.array(blocks_of(others)), free), 1)  # the blocks are made once
    return F.when((F.size(spans) == 0) | (F.size(others) == 0), spans).otherwise(bound)


def find_personal_data(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) -> (doc_id, spans: array<struct<start, ord, end, kind, base>>), a row per row, in code points, by start and kind.

    Base spans always stay. Candidates that touch no base span and none of an earlier kind get the votes of the
    ``LABELERS``; EM estimates how reliable these are and how likely each pattern of votes is personal
    data; a classifier of the spans' features is trained on that, and adds a candidate with a score of at
    least ``threshold``. Null and empty text has no spans, and an empty table gives no rows; each row is judged
    alike, so repeated rows count as often as they occur and null doc_id needs no care. Other columns are left out.
    Texts are scanned once; only counts by votes and by features, whose number has a bound, come to the driver.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    ordinal = {k: i for i, k in enumerate(SPAN_KINDS)}

    def spans(k: str) -> Column:
        return F.transform(base_spans(text, k), lambda x: F.struct(x["start"].alias("start"), F.lit(ordinal[k]).alias("ord"), x["end"].alias("end"), F.lit(k).alias("kind"), F.lit(True).alias("base")))

    base = F.concat(*map(spans, KINDS))
    scanned = save(docs.select(F.col("doc_id").cast("long"), base.alias("base"), candidate_spans(text).alias("more")), "spans")
    rank = F.create_map(*(F.lit(x) for i, k in enumerate(CANDIDATES) for x in (k, i)))
    found = scanned.withColumn("more", without(F.col("more"), F.col("base")))
    found = found.withColumn("more", F.when(F.size("more") > 1, without(F.col("more"), F.col("more"), lambda x, c: rank[x["kind"]] < rank[c["kind"]])).otherwise(F.col("more")))
    found = save(found, "candidates")
    discard(scanned)
    each = found.where(F.size("more") > 0).select(F.explode("more").alias("c")).groupBy("c.votes", "c.features").count()
    tallies = save(each, "tallies")
    patterns = lambda rows: {(p[0], *map(int, p[1:])): n for v, n in rows for p in [v.split("|")]}
    post, _ = expectation_maximisation(patterns(tallies.groupBy("votes").agg(F.sum("count")).collect()))
    labels = F.create_map(*(x for p, y in sorted(post.items()) for x in (F.lit("|".join(map(str, p))), F.lit(y)))) if post else F.create_map(F.lit(""), F.lit(0.0))
    examples = tallies.groupBy("features").agg(F.sum(labels[F.col("votes")] * F.col("count")), F.sum("count")).collect()
    scores = span_classifier({tuple(f.split("|")): (true, n) for f, true, n in examples})
    good = ["|".join(f) for f, s in sorted(scores.items()) if s >= threshold]
    kinds = F.create_map(*(F.lit(x) for k, i in ordinal.items() for x in (k, i)))
    added = F.filter("more", lambda c: c["features"].isin(good)) if good else F.slice("more", 1, 0)
    added = F.transform(added, lambda c: F.struct(c["start"].alias("start"), F.element_at(kinds, c["kind"]).alias("ord"), c["end"].alias("end"), c["kind"].alias("kind"), F.lit(False).alias("base")))
    return found.select("doc_id", F.array_sort(F.concat("base", added)).alias("spans"))


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
