"""Personal data by candidate gradient boosting, in DataFrame and SQL functions throughout.

Strict patterns give the base spans, which always stay.  Wider generators propose more spans, which may overlap one
another and the base.  Boosted trees judge a proposal by its format (lengths, digits, separators, checksums, spelt-out
signs) and its context (what stands before and behind it); thresholds calibrated on rows that the trees have not seen
select what is added.

The trees learn from all spans, counted by format and context; proposals weigh, taken together, as much as base spans.
Base spans are right; so are their
rewritings in looser forms (spelt-out signs, other separators, no plus sign).  Proposals that touch no base span are
wrong, since the strict patterns find none of their kind there.
"""

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from sightline.llm.common import digest_text, settle

KINDS = ["email", "ip", "card", "phone"]
#: Possessive forms of the strict patterns: the same matches, without going back.  A run of e-mail characters or digits
#: is tried from its start only (or from the last match's end), since no later start in it can match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20?[(\[](?:at|AT)[)\]]\x20?|\x20(?:at|AT)\x20|\x20?@\x20?)[A-Za-z0-9-]{1,63}+(?:(?:\x20?[(\[](?:dot|DOT)[)\]]\x20?|\x20(?:dot|DOT)\x20|\x20?\.\x20?)[A-Za-z0-9-]{2,24}+){1,4}+",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:\x20?[.,]\x20?[0-9]{1,3}+){3}+",
    "card": r"(?<![0-9])[0-9](?:[\x20./-]{0,2}+[0-9]){11,18}+",
    "phone": r"(?<![0-9])(?:\+|00)?\(?[0-9]{1,4}+\)?(?:[\x20./-]{1,2}+\(?[0-9]{2,4}+\)?){2,4}+",
}
#: Texts without what a pattern needs are not searched by it.
NEEDS = {"email": r"@|(?i:[\x20(\[]at[\x20)\]])", "ip": r"[0-9]\x20?[.,]\x20?[0-9]", "card": r"[0-9](?:[\x20./-]{0,2}+[0-9]){11}", "phone": r"[0-9][\x20()./-]{1,3}[0-9]|\+[0-9]"}
CUES = {"email": r"(?i)(?:e-?mail|mailto|contact|correo|courriel)\W*$", "ip": r"(?i)(?:\bip|host|server|address)\W*$",
        "card": r"(?i)(?:card|visa|karte|carte|tarjeta|credit)\W*$", "phone": r"(?i)(?:tel|phone|call|fax|mobile|handy)\W*$"}
TREES, DEPTH, PRECISION, CONTEXT = 8, 3, 0.98, 24
FEATURES = ["kind_no", "chars", "digits", "letters", "blanks", "marks", "groups", "longest", "at_sign", "at_word", "dot_word", "plus", "luhn", "octets", "cue", "before", "after"]


def found(docs: DataFrame) -> DataFrame:
    """All matches of all patterns, one row each, and one row without ``kind`` per document: ``row``, ``doc_id``,
    ``kind``, ``wide``, ``at`` (how manieth), ``span`` (its text), ``gap`` (code points since the last match) and context."""
    text = F.col("text")
    tries = []
    for wide, patterns in ((False, BASE), (True, WIDE)):
        for kind, pattern in patterns.items():
            here = text.rlike(NEEDS[kind])
            tries.append(F.struct(F.lit(kind).alias("kind"), F.lit(wide).alias("wide"), F.when(here, F.regexp_extract_all(text, F.lit(pattern), 0)).alias("spans"),
                                  F.when(here, F.split(text, pattern, -1)).alias("pieces")))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    tried = rows.select("row", "doc_id", F.explode(F.array(F.struct(F.lit(None).cast("string").alias("kind"), F.lit(False).alias("wide"),
                        F.array(F.lit("")).alias("spans"), F.array(F.lit(""), F.lit("")).alias("pieces")), *tries)).alias("_try")).where("size(_try.spans) > 0")
    each = tried.select("row", "doc_id", F.col("_try.kind").alias("kind"), F.col("_try.wide").alias("wide"),
                        F.posexplode(F.arrays_zip(F.col("_try.spans").alias("span"), F.col("_try.pieces").alias("piece"),
                                                  F.expr("slice(_try.pieces, 2, size(_try.pieces))").alias("next"))).alias("at", "_m"))
    return (each.where("_m.span IS NOT NULL")
            .select("row", "doc_id", "kind", "wide", "at", F.col("_m.span").alias("span"), F.length("_m.piece").alias("gap"),
                    F.right(F.col("_m.piece"), F.lit(CONTEXT)).alias("behind"), F.left(F.col("_m.next"), F.lit(CONTEXT)).alias("ahead")))


def placed(rows: DataFrame) -> DataFrame:
    """``found`` rows with ``start`` and ``end`` in code points: running sums of gaps and spans within a text."""
    upto = Window.partitionBy("row", "kind", "wide").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("span")
    return rows.withColumn("end", F.sum(F.col("gap") + size).over(upto)).withColumn("start", F.col("end") - size)


def luhn(digits: Column) -> Column:
    """Whether a string of at most 19 digits passes the checksum."""
    def step(total: Column, k: Column) -> Column:
        digit = F.substring(F.concat(F.lit("0" * 19), digits), -k, F.lit(1)).cast("int")
        return total + F.when(k % 2 == 1, digit).when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
    return F.aggregate(F.sequence(F.lit(1), F.lit(19)), F.lit(0), step) % 10 == 0


def octets(span: Column) -> Column:
    """Whether every number of a span is at most 255."""
    def small(part: Column) -> Column:
        number = F.regexp_replace(part, "^0+", "")
        return (F.length(number) <= 3) & (F.coalesce(number.try_cast("int"), F.lit(0)) <= 255)
    return F.forall(F.split(span, r"[^0-9]+"), small)


def count_of(span: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(span, pattern, "")).cast("double")


def described(rows: DataFrame) -> DataFrame:
    """``rows`` (kind, span, behind, ahead) with the columns ``FEATURES`` and ``valid``, whether a strict span holds."""
    span, digits = F.col("span"), F.regexp_replace("span", "[^0-9]", "")
    n = F.length(digits)
    sum_ok, small = (n >= 12) & (n <= 19) & luhn(F.right(digits, F.lit(19))), octets(span)
    char = lambda c: F.when(c == "", 0.0).when(c.rlike(r"^[\p{L}]$"), 1.0).when(c.rlike(r"^[0-9]$"), 2.0).when(c.rlike(r"^\s$"), 3.0).otherwise(4.0)
    cue, kind_no, valid = F.lit(False), F.lit(None).cast("double"), F.lit(False)
    for k, kind in enumerate(KINDS):
        ok = {"email": F.lit(True), "ip": small, "card": sum_ok, "phone": (n >= 9) & (n <= 15)}[kind]
        cue = cue | ((F.col("kind") == kind) & F.col("behind").rlike(CUES[kind]))
        kind_no = F.coalesce(kind_no, F.when(F.col("kind") == kind, F.lit(float(k))))
        valid = valid | ((F.col("kind") == kind) & ok)
    groups = F.split(span, r"[^A-Za-z0-9]+")
    flag = lambda c: c.cast("double")
    return rows.withColumns({
        "kind_no": kind_no, "valid": valid, "chars": flag(F.length(span)), "digits": flag(n), "letters": count_of(span, "[^A-Za-z]"), "blanks": count_of(span, r"[^\x20]"),
        "marks": count_of(span, r"[A-Za-z0-9\x20]"), "groups": flag(F.size(groups)), "longest": flag(F.array_max(F.transform(groups, F.length))),
        "at_sign": flag(span.contains("@")), "at_word": flag(span.rlike(r"(?i)[\x20(\[]at[\x20)\]]")), "dot_word": flag(span.rlike(r"(?i)[\x20(\[]dot[\x20)\]]")),
        "plus": flag(span.startswith("+")), "luhn": flag(sum_ok), "octets": flag(small), "cue": flag(cue),
        "before": char(F.right("behind", F.lit(1))), "after": char(F.left("ahead", F.lit(1))),
    })


def rewritten(good: DataFrame) -> DataFrame:
    """Right spans in looser forms."""
    kind, span = F.col("kind"), F.col("span")
    loose = (F.when(kind == "email", F.array(F.replace(F.replace(span, F.lit("@"), F.lit(" at ")), F.lit("."), F.lit(" dot ")),
                                             F.replace(span, F.lit("@"), F.lit(" (at) ")), F.replace(span, F.lit("@"), F.lit(" @ "))))
             .when(kind == "ip", F.array(F.replace(span, F.lit("."), F.lit(" . "))))
             .when(kind == "card", F.array(F.regexp_replace(F.regexp_replace(span, "[^0-9]", ""), "([0-9]{4})(?=[0-9])", "$1.")))
             .when(kind == "phone", F.array(F.regexp_replace(span, r"^\+", ""), F.regexp_replace(span, r"^\+", "00"))))
    return good.withColumn("span", F.explode(loose))


def counted(spans: DataFrame) -> DataFrame:
    """How often (``n``) each description occurs among all spans to learn from, by ``label`` and by whether it is ``held``
    back from the trees for the thresholds."""
    right = spans.where("NOT wide AND valid")
    loose = described(rewritten(right.select("row", "start", "kind", "span", "behind", "ahead")))
    columns = [(F.pmod(F.xxhash64("row", "start"), F.lit(3)) == 0).alias("held"), "kind", *FEATURES]
    labelled = [part.select(F.lit(label).alias("label"), *columns) for part, label in ((right, 1.0), (loose, 1.0), (spans.where("wide AND NOT touched"), 0.0))]
    every = labelled[0].unionByName(labelled[1]).unionByName(labelled[2])
    return every.groupBy(*every.columns).agg(F.count(F.lit(1)).alias("n"))


def learned(spans: DataFrame) -> tuple[GBTClassificationModel, dict[str, float]] | None:
    """Trees, and the least probability for each kind; None where right or wrong spans are lacking."""
    sides = spans.agg(F.count_if(F.expr("NOT wide AND valid")).alias("right"), F.count_if(F.expr("wide AND NOT touched")).alias("wrong")).first()
    if not sides.right or not sides.wrong:
        return None
    weight = F.col("n") * F.when(F.col("label") == 0, sides.right / sides.wrong).otherwise(1.0)
    cases = settle(counted(spans).withColumn("weight", weight))
    if cases.where("NOT held").select("label").distinct().count() < 2:
        return None
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, stepSize=0.3, seed=7, weightCol="weight").fit(ready.transform(cases.where("NOT held")))
    judged = model.transform(ready.transform(cases.where("held"))).select("kind", "label", "weight", vector_to_array("probability")[1].alias("p"))
    # one row per probability that the trees can give
    steps = judged.groupBy("kind", "p").agg(F.sum("weight").alias("all"), F.sum(F.col("weight") * F.col("label")).alias("right"))
    above = Window.partitionBy("kind").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    good = steps.withColumns({"all": F.sum("all").over(above), "right": F.sum("right").over(above)}).where(F.col("right") >= PRECISION * F.col("all"))
    least = {r.kind: max(r.p, 0.5) for r in good.groupBy("kind").agg(F.min("p").alias("p")).collect()}
    return model, {kind: least.get(kind, 1.01) for kind in KINDS}


def personal_spans(docs: DataFrame) -> DataFrame:
    """Spans of personal data in each text.

    Takes ``doc_id`` and ``text``; other columns are ignored.  Returns one row per input row: ``doc_id``, ``base`` and
    ``added``, arrays of (start, kind_no, end, kind) in order; places are code points from 0, ends exclusive.  Added
    spans touch no base span.  Null and empty texts have none; repeated rows get a row each, and a null ``doc_id`` is
    carried.  Where base spans or proposals are lacking nothing can be learned and nothing is added.
    """
    rows = settle(found(docs))
    spans = described(placed(rows.where("kind IS NOT NULL")))
    spans = settle(spans.where("wide OR valid"))
    # a proposal is touched where a base span that starts earlier ends beyond its start, or a later one starts before its end
    earlier = Window.partitionBy("row").orderBy("start", "wide").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("row").orderBy("start", "wide").rowsBetween(1, Window.unboundedFollowing)
    strict_end, strict_start = F.when(~F.col("wide"), F.col("end")), F.when(~F.col("wide"), F.col("start"))
    touched = (F.coalesce(F.max(strict_end).over(earlier) > F.col("start"), F.lit(False))
               | F.coalesce(F.min(strict_start).over(later) < F.col("end"), F.lit(False)))
    spans = settle(spans.withColumn("touched", touched))
    model = learned(spans)
    span = F.struct("start", F.col("kind_no").cast("int").alias("kind_no"), "end", "kind")
    strict = spans.where("NOT wide").select("row", span.alias("span"), F.lit(False).alias("new"))
    if model:
        trees, least = model
        bar = F.coalesce(*(F.when(F.col("kind") == kind, F.lit(p)) for kind, p in least.items()))
        judged = trees.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(spans.where("wide AND NOT touched")))
        strict = strict.unionByName(judged.where(vector_to_array("probability")[1] >= bar).select("row", span.alias("span"), F.lit(True).alias("new")))
    lists = strict.groupBy("row").agg(F.array_sort(F.collect_list(F.when(~F.col("new"), F.col("span")))).alias("base"),
                                      F.array_sort(F.collect_list(F.when(F.col("new"), F.col("span")))).alias("added"))
    none = F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint,kind:string>>")
    return (rows.where("kind IS NULL").select("row", "doc_id").join(lists, "row", "left")
            .select("doc_id", F.coalesce("base", none).alias("base"), F.coalesce("added", none).alias("added")))


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def summary(spans: DataFrame) -> DataFrame:
    def number_of(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = map(number_of, KINDS)
    return spans.select("doc_id", *counts, digest_text(written(F.col("base"))).alias("base_sha256"),
                        written(F.array_sort(F.concat("base", "added"))).alias("spans"))
