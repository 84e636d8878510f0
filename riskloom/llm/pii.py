"""Personal data: candidate spans, boosted trees on format and context, calibrated thresholds; DataFrame functions only.

*Base spans* (always kept): e-mail addresses, IP addresses, card numbers and phone numbers by pattern, with
their checks (parts up to 255, Luhn, digit counts); matches that fail are dropped.

*Added spans*: generators of high recall propose number runs, long mixed tokens and ``x@y`` forms, which
may overlap base spans and each other.  Boosted trees (``pyspark.ml``) score them by format (lengths,
character classes, checksums) and context.  They learn from distant labels that owe nothing to the base patterns:
a token is positive if a credential word stands before it (``CREDENTIAL``), a number run if a word for a phone or an
account does (``NAMED``) or if it is grouped as phone numbers are written without ``+`` (``GROUPED``), a contact if a
word for mail does (``MAIL``) or if it ends in a domain in any script (``DOMAIN``).  Only candidates apart from all
base spans, those that can be added, are labelled and calibrated on, and all of them are: those of equal format and
label are one row with their number as its weight.  A third, by a hash, is held out, and each family's threshold is the
lowest score from which the held-out precision reaches ``precision`` (that of all its labelled rows if none is held out).  A family whose
labelled candidates are all positive adds every candidate, one without a positive adds none, however few they are.
Positive numbers and contacts, and tokens to which a credential word is assigned (``ASSIGNED``), are added whatever
their score; the trees find more of their format.
The trees become one SQL expression that filters each row's candidates in place: no shuffle, whatever the number
of spans.

Positions come from splitting the text at the matches: a match starts where the pieces and matches
before it end, in code points.  Patterns use possessive loops, which take no stack, and equal the greedy
ones because nothing that follows could make them give back.  Those that begin with a loop are tried only where the last match
ended or where its characters begin: further inside they would fail for the same reason, and long runs of
characters would take quadratic time.

Defined cases: null and empty texts have no spans; equal rows get equal spans; several kinds may overlap;
empty tables give no rows and no model; other columns pass through whatever their names.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, read_table

#: Base kinds in the order of the digest: pattern, and a character without which there is no match.
BASE = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
#: Generators: pattern, and the kind of a span that is added.
FAMILIES = {
    "number": (r"(?<![A-Za-z0-9])[0-9(][0-9\x20().-]{6,}[0-9](?![A-Za-z0-9])", "account"),
    "token": (r"[A-Za-z0-9_-]{16,}+", "secret"),
    "contact": (r"(?:\G|(?<![^\x20\x09-\x0D@]))[^\x20\x09-\x0D@]++@[^\x20\x09-\x0D@]++", "contact"),
}
CREDENTIAL = r"(?i)(token|passw|secret|key|api|auth)[a-z_]*[^a-z0-9]{0,4}$"
#: Words before a number: phone, fax, account and card in the four languages; a whole word, then up to 6 other characters.
NAMED = r"(?i)(?<![\p{L}])(?:(?:tele)?(?:phone|fon|fax)|t[eé]l(?:[eé]fono|[eé]phone)?|call|mobile|m[oó]vil|portable|handy|whatsapp|iban|account|konto|cuenta|compte)(?:\x20?(?:number|no|nr|num|nummer))?[^\p{L}0-9]{1,6}$"
#: Phone numbers without ``+``: 3-3-4 with an optional country code, French pairs, an area code that begins with 0.
GROUPED = r"(?<![0-9])(?<![0-9][.-])(?:\([0-9]{3}\)\x20?[0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}([\x20.-])[0-9]{3}\1[0-9]{4}|0[1-9](?:[\x20.-][0-9]{2}){4}|\(0[0-9]{1,4}\)\x20?[0-9]{4,8}|0[1-9][0-9]{1,3}[\x20-][0-9]{5,8})(?![.-]?[0-9])"
MAIL = r"(?i)(?<![\p{L}])(?:e-?mail|mail|mailto|contact|kontakt|correo|courriel|contacto)[^\p{L}0-9]{1,6}$"
DOMAIN = r"^[\p{L}\p{N}\p{Punct}]*[\p{L}\p{N}]@(?:[\p{L}\p{N}-]+\.)+\p{L}{2,}[^\p{L}\p{N}]*$"
ASSIGNED = r"[=:][\x20\"']{0,3}$"
FEATURES = ("family", "length", "digits", "letters", "upper", "spaces", "dots", "hyphens", "parens", "distinct", "runs", "luhn", "max_part", "quoted")


def spans(text: Column, pattern: str, block: int = 256) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, found), in code points.

    An array grows by copying, so matches are placed in blocks and the blocks then one after another.
    """
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(pieces.alias("piece"), found.alias("found"))
    empty = F.array().cast("array<struct<start:int,end:int,found:string>>")

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.char_length(pair["piece"])
        end = start + F.char_length(pair["found"])
        own = F.array(F.struct(start.alias("start"), end.alias("end"), pair["found"].alias("found")))
        return F.when(pair["found"].isNull(), acc).otherwise(F.struct(end.alias("at"), F.concat(acc["out"], own).alias("out")))

    def follow(acc: Column, part: Column) -> Column:
        moved = F.transform(part["out"], lambda s: F.struct((s["start"] + acc["at"]).alias("start"), (s["end"] + acc["at"]).alias("end"), s["found"].alias("found")))
        return F.struct((acc["at"] + part["at"]).alias("at"), F.concat(acc["out"], F.array(moved)).alias("out"))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / block).cast("int")), lambda b: F.slice(pairs, b * block + 1, F.lit(block)))
    parts = F.transform(blocks, lambda b: F.aggregate(b, F.struct(F.lit(0).alias("at"), empty.alias("out")), step))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int,found:string>>>").alias("out"))
    return F.aggregate(parts, start, follow, lambda acc: F.flatten(acc["out"]))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), d.cast("int") + 1)))
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0))) % 10 == 0


def _passes(kind: str, found: Column) -> Column:
    n = F.length(_digits(found))
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return n.between(13, 19) & luhn(F.when(n.between(13, 19), _digits(found)).otherwise(F.lit("1")))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    pattern, needs = BASE[kind]
    present = F.contains(text, F.lit(needs)) if needs else text.rlike("[0-9](?:[ -]?[0-9]){12}")
    empty = F.array().cast("array<struct<start:int,end:int,found:string>>")
    return F.when(present, F.filter(spans(text, pattern), lambda s: _passes(kind, s["found"]))).otherwise(empty)


def _count(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{pattern}]", "")).cast("double")


def candidates(text: Column, family: str) -> Column:
    """A family's spans with ``FEATURES`` and what is evident from them and the 24 characters before."""
    pattern = FAMILIES[family][0]
    wanted = {"number": lambda s: F.length(_digits(s["found"])) >= 7, "token": lambda s: s["found"].rlike("[0-9]") & s["found"].rlike("[A-Za-z]"), "contact": lambda s: F.lit(True)}[family]
    present = {"number": text.rlike("[0-9(][0-9 ().-]{6}"), "token": text.rlike("[A-Za-z0-9_-]{16}"), "contact": F.contains(text, F.lit("@"))}[family]

    def described(s: Column) -> Column:
        found = s["found"]
        # Formats are told by the first 64 characters; lengths are whole.
        head = F.substring(found, 1, 64)
        n = F.length(_digits(found))
        before = F.substring(text, F.greatest(F.lit(1), s["start"] - 23), F.least(F.lit(24), s["start"]))
        value = {
            "family": F.lit(float(list(FAMILIES).index(family))), "length": F.char_length(found).cast("double"), "digits": n.cast("double"),
            "letters": _count(head, "A-Za-z"), "upper": _count(head, "A-Z"), "spaces": _count(head, r"\x20"), "dots": _count(head, "."), "hyphens": _count(head, r"\-"), "parens": _count(head, "()"),
            "distinct": F.size(F.array_distinct(F.split(head, ""))).cast("double"),
            "runs": F.length(F.regexp_replace(F.regexp_replace(head, "[0-9]+", "9"), "[A-Za-z]+", "a")).cast("double"),
            "luhn": F.when(n.between(13, 19) & luhn(F.substring(_digits(head), 1, 19)), 1.0).otherwise(0.0),
            "max_part": F.array_max(F.transform(F.split(head, "[^0-9]+"), lambda p: F.coalesce(F.substring(p, 1, 6).try_cast("int"), F.lit(0)))).cast("double"),
            "quoted": before.rlike("[\"'=]$").cast("double"),
        }
        evident = {"number": lambda: before.rlike(NAMED) | found.rlike(GROUPED), "token": lambda: before.rlike(CREDENTIAL), "contact": lambda: before.rlike(MAIL) | found.rlike(DOMAIN)}[family]()
        sure = evident & before.rlike(ASSIGNED) if family == "token" else evident
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), evident.alias("evident"), sure.alias("sure"), *[value[f].alias(f) for f in FEATURES])

    shape = "array<struct<start:int,end:int,evident:boolean,sure:boolean," + ",".join(f"{f}:double" for f in FEATURES) + ">>"
    return F.when(present, F.transform(F.filter(spans(text, pattern), wanted), described)).otherwise(F.array().cast(shape))


def tree_sql(debug: str) -> list[str]:
    """The trees of a fitted ensemble's text form as nested CASE expressions over a struct ``c``."""

    def node(lines: list[str]) -> str:
        line = lines.pop(0).strip()
        if line.startswith("Predict:"):
            return f"{float(line.split()[1])!r}D"
        m = re.match(r"If \(feature (\d+) <= (.*)\)", line)
        yes = node(lines)
        lines.pop(0)  # Else
        return f"CASE WHEN c.{FEATURES[int(m[1])]} <= {float(m[2])!r}D THEN {yes} ELSE {node(lines)} END"

    parts = re.split(r"\n\s*Tree \d+ \(weight ([-0-9.eE]+)\):\n", debug)[1:]
    return [f"{float(w)!r}D * ({node([x for x in body.splitlines() if x.strip()])})" for w, body in zip(parts[::2], parts[1::2])]


class SpanModel:
    """Score of a candidate as SQL over ``c`` (None: no model), and a threshold for each family."""

    def __init__(self, score: str | None, thresholds: dict[str, float]):
        self.score, self.thresholds = score, thresholds


def training_rows(docs: DataFrame) -> DataFrame:
    """(FEATURES, label, _held, n): every candidate of ``docs`` that can be added, equal ones counted; one pass over the texts."""
    text = F.col("text")
    found = docs.where(text.rlike("[0-9@]")).select(F.concat(*[candidates(text, f) for f in FAMILIES]).alias("all"), F.concat(*[base_spans(text, k) for k in BASE]).alias("base"))
    free = F.filter("all", lambda c: F.forall("base", lambda b: _apart(c, b)))
    # The outer form keeps Spark from finding the candidates twice, for a filter of empty arrays and for the rows.
    each = found.select(F.explode_outer(free).alias("c")).where(F.col("c").isNotNull())
    described = each.select("c.*", F.col("c.evident").cast("double").alias("label"), (F.pmod(F.xxhash64("c"), F.lit(3)) == 0).alias("_held"))
    return described.groupBy(*FEATURES, "label", "_held").agg(F.count("*").alias("n"))


def fit_spans(docs: DataFrame, precision: float = 0.98) -> SpanModel:
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = materialise(training_rows(docs), "pii-candidates")
    labels = [r["label"] for r in rows.where("not _held").select("label").distinct().collect()]
    if rows.isEmpty():
        return SpanModel(None, {})
    score = "0.0D"  # one label only: nothing to tell apart
    if len(labels) > 1:
        vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        known = rows.where("not _held")
        # Spark takes split points from max(10000, maxBins ** 2) rows: with as many bins as the root of the rows, from all.
        bins = max(32, math.isqrt(known.count()) + 1)
        model = GBTClassifier(maxIter=8, maxDepth=3, stepSize=0.3, seed=7, maxBins=bins, weightCol="n").fit(vector.transform(known))
        score = " + ".join(tree_sql(model.toDebugString))
    scored = rows.select("family", "label", "_held", "n", F.expr(score.replace("c.", "")).alias("score")).groupBy("family", "score", "_held").agg(F.sum(F.col("label") * F.col("n")).alias("yes"), F.sum("n").alias("n")).collect()
    thresholds = {}
    for at, family in enumerate(FAMILIES):
        own = [r for r in scored if r["family"] == at]
        if own and all(r["yes"] == r["n"] for r in own):
            thresholds[family] = float("-inf")
            continue
        yes = n = 0
        # Scores are sums of leaves, so few are distinct; from the top down, the last that keeps the precision.
        for r in sorted([r for r in own if r["_held"]] or own, key=lambda r: -r["score"]):
            yes, n = yes + r["yes"], n + r["n"]
            if yes >= precision * n:
                thresholds[family] = r["score"]
    return SpanModel(score, thresholds)


def _apart(a: Column, b: Column) -> Column:
    return (a["end"] <= b["start"]) | (b["end"] <= a["start"])


def _added(scored: Column, threshold: float | None) -> Column:
    return F.filter(scored, lambda c: c["sure"] if threshold is None else c["sure"] | (c["score"] >= threshold))


def _as_kind(kind: str) -> Column:
    return F.transform(F.col(f"pii.{kind}"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def found_rows(docs: DataFrame, model: SpanModel) -> DataFrame:
    """(row, pii): input rows as structs with email, ip, card, phone (arrays of start, end, found) and added (kind, start, end)."""
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[base_spans(F.col("text"), k).alias(k) for k in BASE], *[candidates(F.col("text"), f).alias(f"c_{f}") for f in (FAMILIES if model.score else ())])
    added = F.array().cast("array<struct<kind:string,start:int,end:int,score:double,sure:boolean>>")
    taken = F.transform(F.concat(*BASE), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    if model.score:
        scored = [F.expr(f"transform(c_{f}, c -> named_struct('kind', '{FAMILIES[f][1]}', 'start', c.start, 'end', c.end, 'score', {model.score}, 'sure', c.sure))") for f in FAMILIES]
        good = [_added(s, model.thresholds.get(f)) for s, f in zip(scored, FAMILIES)]
        free = F.filter(F.concat(*good), lambda c: F.forall(taken, lambda b: _apart(c, b)))
        out = out.withColumn("free", free)
        # Of overlapping candidates the best stays, then the first.
        better = lambda a, b: (a["score"] > b["score"]) | ((a["score"] == b["score"]) & ((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["kind"] < b["kind"]))))
        added = F.filter("free", lambda c: F.forall("free", lambda d: _apart(c, d) | ~better(d, c)))
    added = F.array_sort(F.transform(added, lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))))
    return out.select("row", F.struct(*BASE, added.alias("added")).alias("pii"))


def find_spans(docs: DataFrame, model: SpanModel, into: str = "pii") -> DataFrame:
    """``docs`` plus its spans as a struct named ``into``, a name that ``docs`` does not have."""
    return found_rows(docs, model).select("row.*", F.col("pii").alias(into))


def _listed(parts: list[Column]) -> Column:
    return F.concat_ws(",", F.flatten(F.array(*parts)))


def _named(kind: str) -> Column:
    return F.transform(F.col(f"pii.{kind}"), lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def redact(docs: DataFrame, model: SpanModel) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; ``n_chars`` follows, other columns stay."""
    each = [_as_kind(k) for k in BASE]
    added = F.transform("pii.added", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    found = found_rows(docs, model).withColumn("_spans", F.array_sort(F.concat(*each, added)))

    def step(acc: Column, s: Column) -> Column:
        # A span that begins inside the one before it only moves the end.
        begun = s["start"] >= acc["at"]
        put = F.concat(acc["out"], F.substring(F.col("row.text"), acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(begun, put).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(F.col("row.text"), acc["at"] + 1, F.char_length("row.text"))))
    text = F.when(F.size("_spans") > 0, done).otherwise(F.col("row.text"))
    fixed = {"text": F.col("_clean").alias("text"), "n_chars": F.char_length("_clean").cast("long").alias("n_chars")}
    return found.withColumn("_clean", text).select(*[fixed.get(c, F.col(f"row.`{c}`")) for c in docs.columns])


def op7_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_spans(docs, fit_spans(docs))
    base = _listed([_named(k) for k in BASE])
    extra = F.transform("pii.added", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    counts = [F.coalesce(F.size(f"pii.{k}"), F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), _listed([*[_named(k) for k in BASE], extra]).alias("spans"))
