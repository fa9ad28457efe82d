"""Personal data: candidate spans, scored by gradient-boosted trees. DataFrame functions and Spark ML only."""

from __future__ import annotations

import functools
import operator

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import staged, table

KINDS = ("email", "ip", "card", "phone")

#: Leftmost non-overlapping matches of the rules. Quantifiers are possessive where nothing
#: that follows could use what they give back; a run that failed from its start is not tried again from inside, unless a
#: match ended there. So long runs cost linear time and no stack.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: High-recall generators: other separators, other bounds, written-out signs.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:@|[ ]?[\[({][ ]?(?i:at)[ ]?[\])}][ ]?)[A-Za-z0-9-]{1,63}+"
    r"(?:(?:\.|[ ]?[\[({][ ]?(?i:dot)[ ]?[\])}][ ]?)[A-Za-z0-9-]{1,63}+){0,8}+",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}+(?:[ ]?[.,:\[\]()]{1,3}[ ]?[0-9]{1,3}+){3}(?![0-9A-Za-z])",
    "card": r"(?<![0-9])[0-9]{3,6}+(?:[ ./_-]{0,3}[0-9]{3,6}+){2,5}+(?![0-9])",
    "phone": r"(?<![0-9.])(?:00|\+)?[ ]?\(?[0-9]{1,4}+\)?(?:[ ./-]{1,2}\(?[0-9]{2,4}+\)?){2,4}+(?![0-9])",
}

OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
OCTETS = rf"^{OCTET}(?:[^0-9]+{OCTET}){{3}}$"
CONTACT = r"(?i)\b(?:call|phone|tel|mobile|fax|mail|e-?mail|contact|write|card|visa|pay|credit|account|ip|host|server|address)\b"
NUMBER = r"(?i)\b(?:token|key|id|no|nr|order|invoice|version|isbn|sku|page|fig|table|total|sum|price)\b"
CONTEXT = 32  # code points read on either side of a candidate

TASK_CANDIDATES = 20_000  # candidates of a task, about, when the trees are fitted
TREES, DEPTH = 20, 4
PRECISION = 0.95  # of the held-out candidates that a kind's threshold lets pass
WEAK = 0.2  # weight of a candidate that no rule confirms, but that is well-formed in another spelling
BLOCK = 256
SPANS = "array<struct<kind:string,start:long,end:long>>"


def running_starts(lengths: Column) -> Column:
    """Sums of all earlier elements of an array of lengths. In blocks, as appending to an array copies it."""

    def block(acc: Column, number: Column) -> Column:
        return F.aggregate(
            F.slice(lengths, number * BLOCK + 1, F.lit(BLOCK)),
            F.struct(acc["total"].alias("total"), F.array().cast("array<long>").alias("starts")),
            lambda a, n: F.struct((a["total"] + n).alias("total"), F.concat(a["starts"], F.array(a["total"])).alias("starts")),
            lambda a: F.struct(a["total"].alias("total"), F.concat(acc["starts"], a["starts"]).alias("starts")),
        )

    zero = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<long>").alias("starts"))
    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int"))
    return F.aggregate(blocks, zero, block, lambda a: a["starts"])


def spans_of(text: Column, pattern: str) -> Column:
    """All matches, as structs of start, end (code points) and match.

    Splitting at the pattern gives the text between the matches, so the starts are running sums of lengths.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda s: F.length(s).cast("long"))
    steps = F.zip_with(F.slice(between, 1, F.size(matches)), matches, lambda gap, m: gap + F.length(m))
    ends = F.zip_with(running_starts(steps), steps, lambda start, step: start + step)
    spans = F.zip_with(
        ends, matches, lambda end, m: F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("match"))
    )
    none = F.array().cast("array<struct<start:long,end:long,match:string>>")
    return F.when(F.size(matches) > 0, spans).otherwise(none)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Whether 12 to 19 digits pass the check sum; other lengths don't."""
    digits = _digits(match)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, i: acc
        + F.when(i % 2 == 1, F.substring(digits, -i, F.lit(1)).cast("int")).otherwise(
            F.substring(digits, -i, F.lit(1)).cast("int") * 2 - F.when(F.substring(digits, -i, F.lit(1)) > "4", 9).otherwise(0)
        ),
    )
    return F.when(F.length(digits).between(12, 19), total % 10 == 0).otherwise(False)


def valid(kind: str, match: Column) -> Column:
    """Whether a base match counts."""
    if kind == "ip":
        return match.rlike(OCTETS)
    if kind == "card":
        return luhn(match)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _possible(kind: str, text: Column) -> Column:
    """A cheap test that spares most texts the search for this kind."""
    if kind == "email":
        return text.contains("@") | text.rlike(r"(?i)[\[({] ?at ?[\])}]")
    return text.rlike("[0-9]")


def base_spans(text: Column, kind: str) -> Column:
    found = F.filter(spans_of(text, BASE[kind]), lambda s: valid(kind, s["match"]))
    kept = F.transform(found, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return F.when(_possible(kind, text), kept).otherwise(F.array().cast(SPANS))


def wide_spans(text: Column, kind: str) -> Column:
    def candidate(s: Column) -> Column:
        before = F.substring(text, F.greatest(s["start"] - CONTEXT + 1, F.lit(1)).cast("int"), F.least(s["start"], F.lit(CONTEXT)).cast("int"))
        after = F.substring(text, (s["end"] + 1).cast("int"), F.lit(CONTEXT))
        return F.struct(F.lit(kind).alias("kind"), s["start"], s["end"], s["match"], before.alias("before"), after.alias("after"))

    # without the blank that a pattern may begin with
    trimmed = F.transform(
        spans_of(text, WIDE[kind]),
        lambda s: F.struct((s["end"] - F.length(F.ltrim(s["match"]))).alias("start"), s["end"].alias("end"), F.ltrim(s["match"]).alias("match")),
    )
    found = F.transform(trimmed, candidate)
    none = F.array().cast("array<struct<kind:string,start:long,end:long,match:string,before:string,after:string>>")
    return F.when(_possible(kind, text), found).otherwise(none)


def _count(match: Column, characters: str) -> Column:
    return F.length(F.regexp_replace(match, f"[^{characters}]", ""))


def _plain_email(match: Column) -> Column:
    """A candidate with its written-out signs as signs."""
    signs = F.regexp_replace(match, r"(?i)[ ]?[\[({][ ]?at[ ]?[\])}][ ]?", "@")
    return F.regexp_replace(signs, r"(?i)[ ]?[\[({][ ]?dot[ ]?[\])}][ ]?", ".")


def respelled(kind: Column, match: Column) -> Column:
    """A confirmed match in a spelling that the rules do not know, one of four by a hash; null if it has none."""
    local, domain = F.substring_index(match, "@", 1), F.substring_index(match, "@", -1)
    abroad = F.regexp_replace(match, r"^\+[ ]?", "")
    digits = _digits(match)
    spellings = {
        "email": [
            *[F.concat(local, F.lit(at), F.regexp_replace(domain, r"\.", dot)) for at, dot in ((" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"))],
            F.concat(local, F.lit(" [at] "), domain),
        ],
        "ip": [F.regexp_replace(match, r"\.", sign) for sign in (",", ":", "[.]", " . ")],
        "card": [F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", "$1" + sign) for sign in (".", "/", "_", " - ")],
        "phone": [
            F.concat(F.lit("00"), abroad),
            F.concat(F.lit("00 "), abroad),
            F.concat(F.lit("00"), F.regexp_replace(abroad, "[ -]+", ".")),
            F.regexp_replace(abroad, r"^[0-9]{1,3}[ .-]{1,2}", ""),
        ],
    }
    which = (F.pmod(F.xxhash64("row", "start", "kind"), F.lit(4)) + 1).cast("int")
    out = F.lit(None).cast("string")
    for name, ways in spellings.items():
        spelling = F.element_at(F.array(*ways), which)
        out = F.when((kind == name) & spelling.rlike(f"^(?:{WIDE[name]})$"), spelling).otherwise(out)
    return out


def examples(candidates: DataFrame) -> DataFrame:
    """What the trees learn from: ``label``, ``weight`` and features of candidates with ``base``.

    Positive are the confirmed candidates, respelled as the rules do not know them, as only such candidates can be added.
    What is free of base spans is not negative for that: written-out addresses and numbers after 00 are left out, other
    well-formed ones count as negative with a small weight, malformed ones and those of another kind with a full one.
    """
    kind, match = F.col("kind"), F.col("match")
    confirmed = _overlaps(F.col("base"), kind, F.col("start"), F.col("end"))
    other = ~confirmed & F.exists("base", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    n_digits = F.length(_digits(match))
    unknown = (kind == "email") & _plain_email(match).rlike(f"^{BASE['email']}$")
    unknown = unknown | (kind == "phone") & match.startswith("00") & (n_digits - 2).between(9, 15)
    formed = (kind == "ip") & match.rlike(OCTETS) | (kind == "card") & luhn(match) | (kind == "phone") & n_digits.between(9, 15)
    weight = F.when(confirmed | other, 1.0).when(unknown, 0.0).when(formed, WEAK).otherwise(1.0)
    labelled = candidates.withColumns({"label": confirmed.cast("double"), "weight": weight, "_match": match}).where("weight > 0")
    spelled = labelled.withColumn("match", F.when(F.col("label") == 1, respelled(kind, match)).otherwise(match))
    return spelled.where(F.col("match").isNotNull()).withColumns(features())


def features() -> dict[str, Column]:
    """Format and context of a candidate, as numbers."""
    match, before, after = F.col("match"), F.col("before"), F.col("after")
    numbers = {
        "address": _plain_email(match).rlike(f"^{BASE['email']}$"),
        "length": F.length(match),
        "digits": _count(match, "0-9"),
        "letters": _count(match, "A-Za-z"),
        "dots": _count(match, "."),
        "dashes": _count(match, r"\-"),
        "spaces": _count(match, " "),
        "brackets": _count(match, r"()\[\]{}"),
        "groups": F.size(F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0))),
        "longest_group": F.aggregate(
            F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0)), F.lit(0), lambda a, g: F.greatest(a, F.length(g))
        ),
        "ending": match.rlike(r"(?i)(?:\.|dot[ ]?[\])}][ ]?)[a-z]{2,10}$"),
        "luhn": luhn(match),
        "octets": match.rlike(OCTETS),
        "glued_before": before.rlike("[A-Za-z0-9_.]$"),
        "glued_after": after.rlike("^[A-Za-z0-9_]"),
        "quoted": before.rlike("[\"'=]$"),
        "contact": before.rlike(CONTACT),
        "number": before.rlike(NUMBER),
        "digits_around": _count(F.concat(before, after), "0-9"),
        **{f"is_{kind}": F.col("kind") == kind for kind in KINDS},
    }
    return {name: value.cast("double") for name, value in numbers.items()}


def _overlaps(base: Column, kind: Column, start: Column, end: Column) -> Column:
    return F.exists(base, lambda s: (s["kind"] == kind) & (s["start"] < end) & (s["end"] > start))


def _scored(candidates: DataFrame, model: tuple) -> DataFrame:
    trees, scale, names = model
    assembled = VectorAssembler(inputCols=names, outputCol="_features").transform(candidates)
    margins = trees.transform(assembled).withColumn("_margin", vector_to_array("rawPrediction")[1])
    weight, offset = scale
    return margins.withColumn("_score", F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(weight) * F.col("_margin") + F.lit(offset)))))


def fit(candidates: DataFrame, *, per_task: int = TASK_CANDIDATES, precision: float = PRECISION) -> tuple[tuple, dict[str, float]] | None:
    """Boosted trees, and a calibrated threshold per kind, from ``examples`` of candidates.

    All candidates are used, in as many parts as they fill with about ``per_task`` each: four fifths for the trees, the rest
    to calibrate the margin (logistic) and to find the least threshold that keeps the precision; a kind without held-out
    candidates passes at 0.5, one that reaches the precision nowhere does not pass. None if there is only one class to learn.
    """
    names = list(features())
    tasks = max(1, -(-candidates.count() // per_task))
    chosen = staged(
        candidates.withColumn("_fold", F.pmod(F.xxhash64("_match", "kind"), F.lit(5)))
        .repartition(tasks, "row", "start", "kind")  # a shuffle of the candidates only: the scan before it stays parallel
        .sortWithinPartitions("row", "start", "kind"),
        "candidates",
    )
    train, held = chosen.where("_fold > 0"), chosen.where("_fold = 0")
    if train.select("label").distinct().count() < 2:
        return None
    assembler = VectorAssembler(inputCols=names, outputCol="_features")
    boosting = GBTClassifier(featuresCol="_features", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7)
    trees = boosting.fit(assembler.transform(train))
    scale = (2.0, 0.0)  # the trees' own link
    margins = staged(_scored(held, (trees, scale, names)).select("kind", "label", "weight", "_margin"), "margins")
    if margins.select("label").distinct().count() == 2:
        line = VectorAssembler(inputCols=["_margin"], outputCol="_x").transform(margins)
        platt = LogisticRegression(featuresCol="_x", labelCol="label", weightCol="weight", regParam=0.01).fit(line)
        if platt.coefficients[0] > 0:
            scale = (float(platt.coefficients[0]), float(platt.intercept))
    weight, offset = scale
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(weight) * F.col("_margin") + F.lit(offset))))
    grid = [t / 20 for t in range(10, 20)]
    passed = margins.withColumn("_score", score).groupBy("kind").agg(
        *[
            F.expr(f"sum(CASE WHEN _score >= {t} THEN label * weight END) / sum(CASE WHEN _score >= {t} THEN weight END)").alias(f"p{i}")
            for i, t in enumerate(grid)
        ]
    )
    thresholds = dict.fromkeys(KINDS, 0.5)
    for row in passed.collect():  # one row per kind
        good = [t for i, t in enumerate(grid) if row[f"p{i}"] is not None and row[f"p{i}"] >= precision]
        thresholds[row["kind"]] = min(good, default=1.1)
    return (trees, scale, names), thresholds


def _joined(spans: Column) -> Column:
    """kind:start:end of spans, by start, then kind as listed, then end."""
    order = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("place"),
                s["end"].alias("end"), s["kind"].alias("kind"),
            ),
        )
    )
    return F.concat_ws(
        ",", F.transform(order, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )


def find_personal_data(docs: DataFrame, column: str = "text", *, per_task: int = TASK_CANDIDATES) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``base`` (the spans of the rules) and ``spans`` (these, and the candidates that the
    trees let pass and no base span overlaps), as arrays of structs of kind, start, end (code points, end exclusive).

    Null and empty texts have no spans; spans may overlap; equal rows give equal rows; other columns are ignored; an empty
    table gives no rows. The trees learn from the corpus itself in which contexts the rules confirm what, with
    the confirmed spelled otherwise (see ``examples``).

    The text is read once, into a stored table of the spans; only candidates, a few per document at most, are scored and
    come back by the number of their row.
    """
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    found = docs.select("doc_id", text.alias("_text")).select(
        "doc_id",
        F.concat(*[base_spans(F.col("_text"), kind) for kind in KINDS]).alias("base"),
        F.concat(*[wide_spans(F.col("_text"), kind) for kind in KINDS]).alias("wide"),
    )
    found = staged(found.withColumn("row", F.monotonically_increasing_id()), "spans")
    candidates = found.where(F.size("wide") > 0).select("row", "base", F.explode("wide").alias("c")).select("row", "base", "c.*")
    model = fit(examples(candidates), per_task=per_task)
    if model is None:
        return found.select("doc_id", "base", F.col("base").alias("spans"))
    trees, thresholds = model
    passes = [(F.col("kind") == kind) & (F.col("_score") >= limit) for kind, limit in thresholds.items()]
    free = ~F.exists("base", lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    added = (
        _scored(candidates.where(free).withColumns(features()), trees)
        .where(functools.reduce(operator.or_, passes))
        .groupBy("row")
        .agg(F.collect_set(F.struct("kind", "start", "end")).alias("added"))
    )
    none = F.array().cast(SPANS)
    return found.join(added, "row", "left").select(
        "doc_id", "base", F.concat("base", F.coalesce("added", none)).alias("spans")
    )


def op7_pii(spark: SparkSession, root: str) -> DataFrame:
    found = find_personal_data(table(spark, root, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )
