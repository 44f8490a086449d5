"""Licence scans: a trained classifier of paragraphs, confirmed by templates.

Paragraphs are lines, and runs of lines between blank ones, in windows of words, as notices
are often wrapped. A multinomial logistic regression over words and word pairs, sparse by
its penalty, is trained on licence notices and on paragraphs that are none. Its scores are
calibrated on examples it has not seen, and a paragraph belongs to no family unless its
probability passes a bound under which nearly all others stay. A prediction is confirmed if
the paragraph has enough of the words and word pairs of one of the family's notices.

Scoring is joins and sums: terms of paragraphs meet the weights, a table of fixed size. Left
out before are only paragraphs whose terms cannot add up to what the bound needs.
"""

import json
import math
import re
from dataclasses import dataclass, replace

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from precinct.llm.notices import NOTICES, UNKNOWN, lessons
from precinct.plans.scratch import stored

# Words of notices. Lines with one are the hard negatives, of which the model learns more.
HINTS = (
    r"(?i)licen[cs]|copyright|rights reserved|public domain|spdx|permission|permitted"
    r"|redistribut|warrant|creative commons|cc0|prior written|©|\bgnu\b|\b[al]?gpl|\bmpl\b"
    r"|\bcc by|\beupl\b|proprietary|prohibited"
)

# Paragraphs of the corpus that the model learns as unknown.
SAMPLE = 2_000
# Share of a notice's terms that a paragraph must have.
CONFIRMED = 0.6
# Lines of the corpus that have more of a notice may be one, and are not learned as unknown.
DOUBTFUL = 0.4
# Words of the longest notice; windows of twice as many begin at each multiple.
LONGEST = max(len(re.findall("[A-Za-z0-9]+", n)) for own in NOTICES.values() for n in own)
# Lines that are empty but for marks of a comment end a run.
BLANK = r"\n(?:[\s/*#;%!-]*\n)+"
MARKS = r"(?:^|\n)[\s/*#;%!-]*(?:(?:rem|dnl)\s)?"


@dataclass(frozen=True)
class Model:
    families: tuple[str, ...]  # the last is UNKNOWN
    weights: tuple[tuple[str, tuple[float, ...]], ...]  # term and its weight in each family
    offsets: tuple[float, ...]
    temperature: float
    bound: float
    counts: tuple[tuple[str, int], ...] = ()  # terms with weights in the sampled lines


def words_of(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit("([a-z0-9]+)"))


def terms(line: Column) -> Column:
    """Distinct words and pairs of neighbouring words of a paragraph, in lower case."""
    return F.transform(
        F.array(words_of(line)),
        lambda w: F.array_distinct(
            F.concat(
                w,
                F.transform(
                    F.slice(w, 2, F.size(w)), lambda x, i: F.concat(F.get(w, i), F.lit(" "), x)
                ),
            )
        ),
    ).getItem(0)


def literal(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table that is part of the plan."""
    parsed = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(parsed))


def examples(spark: SparkSession) -> DataFrame:
    """``family line part`` of the lines that the model learns from, and of those it does not."""
    named = [{"family": f, "line": x, "part": p} for f, x, p in lessons()]
    return literal(spark, named, "family: string, line: string, part: int").distinct()


def lines_of(docs: DataFrame, keep) -> DataFrame:
    """``doc_id line`` for the lines that ``keep`` accepts."""
    chosen = F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), keep)
    return docs.select("doc_id", F.explode(chosen).alias("line"))


def notice_table(spark: SparkSession) -> DataFrame:
    """``notice family wanted length``: a fixed table."""
    named = [
        {"family": f, "notice": n, "length": len(re.findall("[A-Za-z0-9]+", n))}
        for f, own in NOTICES.items()
        for n in own
    ]
    rows = literal(spark, named, "family: string, notice: string, length: int")
    return rows.withColumn("wanted", terms(F.col("notice")))


def notice_keys(spark: SparkSession) -> DataFrame:
    """``notice term``: whatever has ``CONFIRMED`` of a notice's terms has one of its keys.

    As many terms as may be missing, and one more; pairs and long words are seldom met.
    """
    table = notice_table(spark).select("notice", "wanted")
    longest = F.reverse(F.array_sort(F.transform("wanted", lambda t: F.struct(F.length(t), t))))
    missing = F.size("wanted") - F.ceil(F.size("wanted") * CONFIRMED - 1e-9)
    keys = F.slice(longest, F.lit(1), missing.cast("int") + 1)
    return table.select("notice", F.explode(keys).alias("key")).select("notice", "key.*").toDF(
        "notice", "length", "term"
    ).drop("length")


def shares(paragraphs: DataFrame, keys: list[str], least: float) -> DataFrame:
    """``keys notice part`` where rows with ``terms`` have at least this part of a notice."""
    wanted = notice_table(paragraphs.sparkSession).select(
        "notice", F.size("wanted").alias("size"), F.explode("wanted").alias("term")
    )
    spread = paragraphs.select(*keys, F.explode("terms").alias("term"))
    met = spread.join(F.broadcast(wanted), "term").groupBy(*keys, "notice")
    part = met.agg((F.count("*") / F.first("size")).alias("part"))
    return part.filter(F.col("part") >= least)


def fit(docs: DataFrame) -> Model:
    """Learns families from the notices, and unknown from up to ``SAMPLE`` lines of ``docs``.

    The lines come from documents chosen by a hash of their id: all lines with a word of
    ``HINTS`` and a quarter of the others. Lines that have much of a notice are left out, as
    they may be one. What reaches the driver is bounded by ``SAMPLE``.
    """
    spark = docs.sparkSession
    count = max(1, docs.count())
    draw = F.pmod(F.xxhash64(F.lit("licence"), "doc_id"), F.lit(1 << 40)) / float(1 << 40)
    some = docs.filter(draw < min(1.0, SAMPLE / count))
    rare = lambda x: x.rlike(HINTS) | (F.pmod(F.xxhash64(x), F.lit(4)) == 0)
    drawn = lines_of(some, lambda x: (F.octet_length(x) > 0) & rare(x)).distinct()
    drawn = drawn.select("line", terms(F.col("line")).alias("terms"))
    doubtful = shares(drawn, ["line"], DOUBTFUL).select("line").distinct()
    lines = drawn.select("line").distinct().join(doubtful, "line", "left_anti")
    plain = lines.orderBy(~F.col("line").rlike(HINTS), F.xxhash64("line")).limit(SAMPLE)
    unknown = stored(plain.withColumn("terms", terms(F.col("line"))), "unknown")
    lesson = unknown.select(
        F.lit(UNKNOWN).alias("family"),
        "line",
        (F.pmod(F.xxhash64("line", F.lit(1)), F.lit(4)) == 0).cast("int").alias("part"),
        "terms",
    )
    made = examples(spark).withColumn("terms", terms(F.col("line")))
    known = stored(made.unionByName(lesson), "examples")
    families = (*sorted(NOTICES), UNKNOWN)
    number = F.array_position(F.array(*(F.lit(f) for f in families)), F.col("family")) - 1
    rows = known.withColumn("label", number.cast("double"))
    learned = rows.filter("part = 0")
    # Terms of notices and negatives only: words of the corpus would not be bounded.
    counter = CountVectorizer(inputCol="terms", outputCol="features", binary=True, vocabSize=20_000)
    vocabulary = counter.fit(learned.join(examples(spark).select("line").distinct(), "line", "left_semi"))
    kind = LogisticRegression(
        family="multinomial", regParam=1e-4, elasticNetParam=0.5, maxIter=60, standardization=False
    )
    # How many lines name a family says nothing about how often it is named, so each weighs the same.
    among = learned.groupBy("family").count()
    heavy = F.when(F.col("family") == UNKNOWN, F.lit(8.0)).otherwise(F.lit(1.0))
    weighed = learned.join(F.broadcast(among), "family").withColumn("weight", heavy / F.col("count"))
    fitted = kind.setWeightCol("weight").fit(vocabulary.transform(weighed))
    matrix = fitted.coefficientMatrix.toArray()
    present = [i for i in range(matrix.shape[0])]
    weights = tuple(
        (term, tuple(round(float(matrix[i, j]), 6) for i in present))
        for j, term in enumerate(vocabulary.vocabulary)
        if any(abs(matrix[i, j]) > 1e-6 for i in present)
    )
    offsets = tuple(round(float(x), 6) for x in fitted.interceptVector.toArray())
    raw = Model(families, weights, offsets, 1.0, 0.0)
    seen = rows.filter("part = 1").withColumn("doc_id", F.monotonically_increasing_id())
    judged = margins(stored(seen, "held-out"), raw, ["doc_id", "label"]).collect()
    cases = [(int(r["label"]), list(r["margins"])) for r in judged]
    model = calibrated(raw, cases)
    table = literal(spark, [{"term": t} for t, _ in weights], "term: string")
    used = unknown.select(F.explode("terms").alias("term"))
    counted = used.join(F.broadcast(table), "term").groupBy("term").count().collect()
    return replace(model, counts=tuple(sorted((r["term"], r["count"]) for r in counted)))


def softmax(margins: list[float], temperature: float) -> list[float]:
    top = max(margins)
    parts = [math.exp((m - top) / temperature) for m in margins]
    return [p / sum(parts) for p in parts]


def calibrated(raw: Model, cases: list[tuple[int, list[float]]]) -> Model:
    """The temperature with the least surprise, and a bound above all but 1 in 500 unknowns."""

    def surprise(t: float) -> float:
        return -sum(math.log(max(softmax(m, t)[label], 1e-12)) for label, m in cases)

    temperature = min((2 ** (k / 4) for k in range(-12, 13)), key=surprise) if cases else 1.0
    last = len(raw.families) - 1
    wrong = sorted(max(softmax(m, temperature)[:-1]) for label, m in cases if label == last)
    bound = wrong[-1 - len(wrong) // 500] if wrong else 0.0
    return Model(raw.families, raw.weights, raw.offsets, temperature, min(0.95, max(0.5, bound)))


def margins(paragraphs: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """``keys`` and ``margins``, the sum of weights in each family, of rows with ``terms``."""
    spark = paragraphs.sparkSession
    table = literal(
        spark,
        [{"term": t, "w": list(w)} for t, w in model.weights],
        "term: string, w: array<double>",
    )
    spread = paragraphs.select(*keys, F.explode_outer("terms").alias("term"))
    # The table has a row for each term of the notices: a fixed number.
    met = spread.join(F.broadcast(table), "term", "left")
    sums = [
        (F.coalesce(F.sum(F.get("w", F.lit(i))), F.lit(0.0)) + F.lit(offset)).alias(f"m{i}")
        for i, offset in enumerate(model.offsets)
    ]
    names = [f"m{i}" for i in range(len(model.offsets))]
    return met.groupBy(*keys).agg(*sums).select(*keys, F.array(*names).alias("margins"))


def needed(model: Model) -> str:
    """A pattern found in every lower-case paragraph that can pass the bound.

    For each family, some terms can be left out as long as all of them together do not reach
    what the bound needs; a paragraph that passes has one of the others. Left out are
    frequent terms, also for what they add, whichever way leaves the rarest others.
    """
    last, counts = len(model.families) - 1, dict(model.counts)
    strong = set()
    for f in range(last):
        room = model.temperature * math.log(model.bound / (1 - model.bound))
        room -= model.offsets[f] - model.offsets[last] + 1e-6
        if room <= 0:
            return ""
        gains = [(w[f] - w[last], t) for t, w in model.weights if w[f] > w[last]]
        ways = [
            sorted(gains, key=lambda x: (-counts.get(x[1], 0) / x[0] ** power, *x))
            for power in (0.0, 0.5, 1.0)
        ]
        kept = [above(room, way) for way in ways]
        strong |= min(kept, key=lambda terms: sum(counts.get(t, 0) for t in terms))
    return r"(?<![a-z0-9])(?:" + branches(strong) + r")(?![a-z0-9])" if strong else r"(?!)"


def above(room: float, gains: list[tuple[float, str]]) -> set[str]:
    """The terms that are left when those that fit into ``room`` are taken, in this order."""
    left = set()
    for gain, term in gains:
        if gain < room:
            room -= gain
        else:
            left.add(term)
    return left


def branches(words: set[str]) -> str:
    """Alternatives by first character, so that few are tried at each place."""
    out = []
    for c in sorted({w[:1] for w in words}):
        rest = {w[1:] for w in words if w[:1] == c}
        mark = "[^a-z0-9]+" if c == " " else c
        out.append(f"{mark}(?:{branches(rest)})" if c and rest != {""} else mark)
    return "|".join(sorted(out, key=lambda x: x == ""))


def judged(paragraphs: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """``keys family probability`` of rows with ``terms`` that pass the bound."""
    scored = margins(paragraphs, model, keys)
    top = F.array_max("margins")
    parts = F.transform("margins", lambda m: F.exp((m - top) / F.lit(model.temperature)))
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    best = F.array_max(F.slice(parts, 1, len(model.families) - 1))
    place = F.array_position(F.slice(parts, 1, len(model.families) - 1), best).cast("int")
    names = F.array(*(F.lit(f) for f in model.families))
    return scored.select(
        *keys, F.get(names, place - 1).alias("family"), (best / total).alias("probability")
    ).filter(F.col("probability") >= model.bound)


def scan(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id line family probability shared confirmed`` for paragraphs of a known family.

    ``shared`` is the largest part of a notice of the family that the paragraph has. Equal
    lines of a document are one paragraph, and rows that repeat an id are one document. A run
    of lines counts once for a family, if none of its lines is a confirmed notice of it by
    itself; its ``line`` has the words of the window that is most like a notice. Null
    and empty texts have no paragraphs, as has an empty table. Columns other than the id and
    the text are not used.
    """
    spark = docs.sparkSession
    pattern = needed(model)
    passes = lambda x: F.lower(x).rlike(pattern)
    body = F.coalesce(docs[text], F.lit(""))
    runs = docs.select(docs[doc_id].alias("doc_id"), F.explode(F.split(body, BLANK)).alias("body"))
    runs = stored(
        runs.filter((F.octet_length("body") > 0) & passes(F.col("body"))).withColumn(
            "run", F.xxhash64("body")
        ),
        "runs",
    )
    lines = runs.select(
        "doc_id", "run", F.explode(F.filter(F.split("body", "\n", -1), passes)).alias("line")
    )
    keyed = lines.groupBy("doc_id", "line").agg(F.collect_set("run").alias("runs"))
    keyed = keyed.withColumn("paragraph", F.xxhash64("line"))
    paragraphs = stored(keyed.withColumn("terms", terms(F.col("line"))), "paragraphs")
    keys = ["doc_id", "paragraph"]
    predicted = judged(paragraphs, model, keys)
    notices = notice_table(spark)
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("paragraph") == F.col("of_paragraph"))
    named = predicted.toDF("of_doc", "of_paragraph", "family", "probability")
    # Notices are a fixed table.
    compared = paragraphs.join(named, same).join(F.broadcast(notices), "family")
    part = F.size(F.array_intersect("wanted", "terms")) / F.size("wanted")
    single = stored(
        compared.groupBy(*keys).agg(
            F.first("line").alias("line"),
            F.first("family").alias("family"),
            F.first("probability").alias("probability"),
            F.max(part).alias("shared"),
            F.first("runs").alias("runs"),
        ),
        "lines",
    )
    sure = single.filter(F.col("shared") >= CONFIRMED).select(
        "doc_id", F.explode("runs").alias("run"), "family"
    )
    columns = ["doc_id", "line", "family", "probability", "shared"]
    found = wrapped(runs, model, passes).alias("r").join(
        sure.distinct().alias("s"),
        F.expr("r.doc_id <=> s.doc_id AND r.run = s.run AND r.family = s.family"),
        "left_anti",
    )
    found = found.select(*columns).dropDuplicates(["doc_id", "line", "family"])
    every = single.select(*columns).unionByName(found)
    return every.withColumn("confirmed", F.col("shared") >= CONFIRMED)


def wrapped(runs: DataFrame, model: Model, passes) -> DataFrame:
    """``doc_id run line family probability shared`` for notices in runs of several lines.

    Windows that have enough of a notice are narrowed to the words most like it, as many as
    the notice has; the model has to find its family in these. Words that stand in one line
    are left to the scan of lines.
    """
    several = runs.filter(F.col("body").contains("\n"))
    # The first word of a line carries the line break.
    broken = F.regexp_replace(F.lower("body"), MARKS, "\n")
    broken = F.regexp_replace(broken, "\n[^a-z0-9\n]+", "\n")
    words = F.regexp_extract_all(broken, F.lit("(\n?[a-z0-9]+)"))
    spread = several.select("run", words.alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - LONGEST - 1, F.lit(0)), F.lit(LONGEST))
    cut = F.transform(starts, lambda i: F.array_join(F.slice("w", i + 1, 2 * LONGEST), " "))
    windows = spread.select("run", F.explode(F.filter(cut, passes)).alias("window"))
    # Tables of notices are of fixed size. Only windows with a key of a notice are shuffled.
    spark = runs.sparkSession
    keyed = windows.select("run", "window", F.explode(terms(F.col("window"))).alias("term"))
    met = keyed.join(F.broadcast(notice_keys(spark)), "term").select("run", "window", "notice")
    near = met.distinct().join(F.broadcast(notice_table(spark)), "notice")
    part = F.size(F.array_intersect("wanted", terms(F.col("window")))) / F.size("wanted")
    near = near.filter(part >= CONFIRMED).withColumn("w", F.split("window", " "))
    last = F.greatest(F.size("w") - F.col("length"), F.lit(0))
    narrow = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.array_join(F.slice("w", i + 1, F.col("length")), " "),
    )
    tried = near.select(
        "run", "notice", "family", "wanted", F.explode(narrow).alias("line")
    )
    tried = tried.distinct().withColumn("terms", terms(F.col("line")))
    tried = tried.withColumn(
        "shared", F.size(F.array_intersect("wanted", "terms")) / F.size("wanted")
    ).filter(F.col("shared") >= CONFIRMED)
    within = ~F.substring("line", 2, 1 << 30).contains("\n")
    best = tried.groupBy("run", "notice").agg(
        F.max(F.struct("shared", within.alias("within"), "line", "family")).alias("best")
    )
    found = best.select("run", "best.*").filter(~F.col("within")).drop("within").distinct()
    found = found.withColumn("line", F.replace("line", F.lit("\n"), F.lit("")))
    best = stored(found.withColumn("terms", terms(F.col("line"))), "narrowed")
    lines = best.select("line", "terms").dropDuplicates(["line"])
    agreed = best.drop("terms").join(judged(lines, model, ["line"]), ["line", "family"])
    top = agreed.groupBy("run", "family").agg(
        F.max(F.struct("shared", "line", "probability")).alias("best")
    )
    owners = runs.select("doc_id", "run").distinct()
    return owners.join(top, "run").select("doc_id", "run", "family", "best.*")


def licenses(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """``doc_id n_notices families probability`` for every document.

    Counts confirmed notices; ``families`` lists theirs by name, "" if there is none, and
    ``probability`` is the least certain one's (0 if there is none). Rows that repeat an id,
    and so those without one, are one document whose counts stand in each row.
    """
    sure = found.filter("confirmed").groupBy(F.col("doc_id").alias("of_doc")).agg(
        F.count("*").alias("n"),
        F.array_join(F.array_sort(F.collect_set("family")), ",").alias("names"),
        F.min("probability").alias("least"),
    )
    kept = docs.select(docs[doc_id].alias("doc_id"))
    return kept.join(sure, F.col("doc_id").eqNullSafe(F.col("of_doc")), "left").select(
        "doc_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_notices"),
        F.coalesce("names", F.lit("")).alias("families"),
        F.coalesce("least", F.lit(0.0)).alias("probability"),
    )
