"""Personal data in texts by gradient-boosted trees over candidate spans. DataFrame functions only.

Base spans are the checked matches of four patterns, leftmost and not overlapping within a kind. Wider
generators propose further spans, overlapping as they come: from every start all runs of whole number
groups within the digit limits, dotted numbers, addresses with ``at`` and ``dot`` spelled out. Each candidate gets features of its format (digits, groups,
separators, the number of digits in its groups) and of its context (cue words before it, the characters
around it). Boosted trees are fitted on all candidates of all documents whose label the format decides:
checked matches are positive, candidates that fail their kind's check are negative, others say nothing.
One document in five is held back to set a threshold for each kind: the least score at which the
share of positives is ``precision`` or more. Candidates of no label that reach it are added; base spans stay.

Trees are written out as CASE expressions, so scoring is one projection without a shuffle.

Defined results: null text counts as empty; where the documents have no positive or no negative candidate, no
spans are added; rows are worked on one by one. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fulltime.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
SPAN = "array<struct<b:int,e:int,m:string>>"

# The patterns. Possessive quantifiers and look-behinds change no match; they keep the time in
# proportion to the text (a run that can't match is tried once), and the stack flat.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What must be in a text for a pattern to be tried.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){13}", "phone": "+"}
#: Generators of candidates: what stands from every start on, looked at without being used up, so starts overlap.
#: Each prefix of it that ends with a group (``ENDS``) and has the form (``FORM``) and digits (``DIGITS``) is proposed.
WIDE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])(?=([A-Za-z0-9._%+-]{1,64}+ ?(?:@|\[at\]|\(at\)|\{at\}) ?[A-Za-z0-9-]{1,63}+"
             r"(?: ?(?:\.|\[dot\]|\(dot\)|\{dot\}) ?[A-Za-z0-9-]{1,63}+){1,8}+))",
    "ip": r"(?<![0-9])(?=([0-9]{1,5}+(?: ?[.:] ?[0-9]{1,5}+){3}+(?![0-9])))",
    "card": r"(?<![0-9])(?=[0-9](?:[ .\-]?[0-9]){12})(?=([0-9]{1,23}+(?![0-9])(?:[ .\-][0-9]{1,23}+(?![0-9])){0,22}+))",
    "phone": r"(?<![0-9])(?=[+(]{0,2}[0-9](?:\)?[ ./-]{0,2}\(?[0-9]){6})"
             r"(?=(\+?\(?[0-9]{1,17}+(?![0-9])\)?(?:[ ./-]{1,2}+\(?[0-9]{1,17}+(?![0-9])\)?){0,16}+))",
}
ENDS = {"email": r"(?<=[A-Za-z0-9-])(?![A-Za-z0-9-])", "phone": r"(?<=[0-9])(?![0-9)])|(?<=\))", "card": r"(?<=[0-9])(?![0-9])"}
FORM = {"email": r"(?i)^[A-Za-z0-9._%+-]+ ?(?:@|\[at\]|\(at\)|\{at\}) ?[A-Za-z0-9-]+(?: ?(?:\.|\[dot\]|\(dot\)|\{dot\}) ?[A-Za-z0-9-]+)+$"}
#: Least and most digits of a proposed span: some beyond what the checks take, so that there are negatives to learn from.
DIGITS = {"card": (13, 23), "phone": (7, 17)}
WIDE_HINT = {"email": r"@|(?i)[\[({](?:at)[\])}]", "ip": r"[0-9] ?[.:] ?[0-9]++ ?[.:] ?[0-9]", "card": r"[0-9](?:[ .\-]?[0-9]){12}",
             "phone": r"[0-9](?:\)?[ ./-]{0,2}\(?[0-9]){6}"}
CUES = {
    "email": r"(?i)mail|contact|write|correo|courriel|kontakt",
    "ip": r"(?i)\bip\b|host|server|address|adresse|direcci",
    "card": r"(?i)card|visa|credit|payment|kredit|karte|tarjeta|carte|konto",
    "phone": r"(?i)phone|tel|call|mobile|fax|telefon|handy|tfno|appel",
}
FEATURES = ["kind", "length", "digits", "letters", "groups", "longest", "seps", "plus", "brackets", "dots", "dashes",
            "spaces", "parts_ok", "first", "cue", "cue_other", "left_alnum", "right_alnum"]
#: Characters before a candidate that are read for cue words.
CONTEXT = 32
#: Ranges that scores from 0 to 1 are cut into for running sums.
RANGES = 4096


def _places(text: Column, pattern: str) -> Column:
    """All matches of a pattern with their places, as an array of (b, e, m)."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(matches)).alias("g"), matches.alias("m"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(s: Column, x: Column) -> Column:
        b = s["at"] + F.length(x["0"])
        e = b + F.length(x["1"])
        return F.struct(e.alias("at"), F.concat(s["out"], F.array(F.struct(b.alias("b"), e.alias("e"), x["1"].alias("m")))).alias("out"))

    zipped = F.transform(pairs, lambda x: F.struct(x["g"].alias("0"), x["m"].alias("1")))
    return F.aggregate(zipped, start, step, lambda s: s["out"])


def _starts(text: Column, pattern: str) -> Column:
    """What a pattern without width captures at each of its places, as an array of (b, m)."""
    t = F.concat(F.lit(" "), text)  # a split drops a match without width at the very start
    matches = F.regexp_extract_all(t, F.lit(pattern), F.lit(1))
    gaps = F.split(t, pattern, -1)
    start = F.struct(F.lit(-1).alias("at"), F.array().cast("array<int>").alias("out"))
    places = F.aggregate(F.slice(gaps, F.lit(1), F.size(matches)), start,
                         lambda s, g: F.struct((s["at"] + F.length(g)).alias("at"), F.concat(s["out"], F.array(s["at"] + F.length(g))).alias("out")),
                         lambda s: s["out"])
    return F.arrays_zip(places.alias("b"), matches.alias("m"))


def proposed(text: Column, kind: str) -> Column:
    """Spans of a kind that the generators propose, overlapping: array of (b, e, m)."""
    found = _starts(text, WIDE[kind])
    if kind not in ENDS:
        return F.transform(found, lambda s: F.struct(s["b"].alias("b"), (s["b"] + F.length(s["m"])).alias("e"), s["m"].alias("m")))

    def prefixes(s: Column) -> Column:
        parts = F.split(s["m"], ENDS[kind], -1)
        upto = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "")))
        if kind in FORM:
            upto = F.filter(upto, lambda m: m.rlike(FORM[kind]))
        if kind in DIGITS:
            upto = F.filter(upto, lambda m: F.length(F.regexp_replace(m, "[^0-9]", "")).between(*DIGITS[kind]))
        return F.transform(upto, lambda m: F.struct(s["b"].alias("b"), (s["b"] + F.length(m)).alias("e"), m.alias("m")))

    return F.flatten(F.transform(found, prefixes))


def _valid(kind: str, m: Column) -> Column:
    """The check of a base match."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
        return m.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return n.between(14, 19) & F.when(n.between(14, 19), F.call_function("luhn_check", digits)).otherwise(False)
    return n.between(10, 15)


def _has(text: Column, hint: str) -> Column:
    return F.contains(text, F.lit(hint)) if hint in ("@", "+") else text.rlike(hint)


def base_spans(text: Column, kind: str) -> Column:
    """Checked matches of a kind: array of (b, e, m)."""
    found = F.filter(_places(text, BASE[kind]), lambda s: _valid(kind, s["m"]))
    return F.when(_has(text, HINT[kind]), found).otherwise(F.array().cast(SPAN))


def _candidates(text: Column, kind: str) -> Column:
    """Proposed spans of a kind with their features."""
    def features(s: Column) -> Column:
        m = s["m"]
        digits = F.regexp_replace(m, "[^0-9]", "")
        before = F.substring(text, F.greatest(s["b"] - CONTEXT, F.lit(0)) + 1, F.least(s["b"], F.lit(CONTEXT)))
        after = F.substring(text, s["e"] + 1, F.lit(1))
        count = lambda p: F.length(F.regexp_replace(m, f"[^{p}]", ""))
        groups = F.split(m, "[^0-9]+", -1)
        other = "|".join(CUES[k].removeprefix("(?i)") for k in KINDS if k != kind)
        cols = {
            "kind": F.lit(KINDS.index(kind)), "length": F.length(m), "digits": F.length(digits), "letters": count("A-Za-z"),
            "groups": F.size(F.filter(groups, lambda g: g != "")), "longest": F.array_max(F.transform(groups, F.length)),
            "seps": F.length(m) - F.length(F.regexp_replace(m, "[^0-9A-Za-z]", "")), "plus": F.contains(m, F.lit("+")).cast("int"),
            "brackets": count(r"()\[\]{}"), "dots": count("."), "dashes": count(r"\-"), "spaces": count(" "),
            "parts_ok": F.forall(F.filter(groups, lambda g: g != ""), lambda g: F.length(g) <= 3).cast("int"),
            "first": F.coalesce(F.try_to_number(F.nullif(F.substring(digits, 1, 1), F.lit("")), F.lit("9")).cast("int"), F.lit(-1)),
            "cue": before.rlike(CUES[kind]).cast("int"), "cue_other": before.rlike(f"(?i){other}").cast("int"),
            "left_alnum": before.rlike(r"[\p{L}\p{N}]$").cast("int"), "right_alnum": after.rlike(r"[\p{L}\p{N}]").cast("int"),
        }
        return F.struct(F.lit(KINDS.index(kind)).alias("k"), s["b"].alias("b"), s["e"].alias("e"),
                        _label(kind, s, f"base_{kind}").alias("label"),
                        *[cols[f].cast("double").alias(f) for f in FEATURES])

    found = F.transform(proposed(text, kind), features)
    return F.when(_has(text, WIDE_HINT[kind]), found).otherwise(F.array())


def _label(kind: str, s: Column, base: str) -> Column:
    """1: a base span; 2: it overlaps one; 0: it has the form of one and fails the check, or is a number of no
    such form, or overlaps a base span of another kind; null: unknown."""
    m = s["m"]
    same = F.exists(F.col(base), lambda x: (x["b"] == s["b"]) & (x["e"] == s["e"]))
    meets = F.exists(F.col(base), lambda x: (x["b"] < s["e"]) & (x["e"] > s["b"]))
    taken = F.exists(F.concat(*[F.col(f"base_{k}") for k in KINDS if k != kind]), lambda x: (x["b"] < s["e"]) & (x["e"] > s["b"]))
    n = F.length(F.regexp_replace(m, "[^0-9]", ""))
    if kind == "email":
        wrong = ~m.rlike(r"[A-Za-z]{2}[)\]}]?$")
    elif kind == "ip":
        wrong = m.rlike(rf"^{BASE['ip']}$") & ~_valid("ip", m) | m.contains(":")
    elif kind == "card":
        wrong = (n < 14) | (n > 19) | ~F.when(n.between(14, 19), F.call_function("luhn_check", F.regexp_replace(m, "[^0-9]", ""))).otherwise(False)
    else:
        wrong = (n < 10) | (n > 15) | m.rlike(r"[0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2}")
    return F.when(same, 1).when(meets, 2).when(wrong | taken, 0)


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``base_<kind>`` span arrays."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.withColumns({f"base_{k}": base_spans(t, k) for k in KINDS})


def with_candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``with_base`` and ``candidates``: array of (k, b, e, label, features)."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    kind = ",".join(f"{f}:double" for f in FEATURES)
    kind = f"array<struct<k:int,b:int,e:int,label:int,{kind}>>"
    return with_base(docs, text).withColumn("candidates", F.concat(*[_candidates(t, k).cast(kind) for k in KINDS]))


def _as_sql(lines: list[str], at: int) -> tuple[str, int]:
    """One node of a printed tree as SQL over a candidate ``c``, and the line after it."""
    line = lines[at].strip()
    if m := re.match(r"Predict: (\S+)", line):
        return f"{float(m[1])!r}D", at + 1
    m = re.match(r"If \(feature (\d+) <= (\S+)\)", line)
    low, at = _as_sql(lines, at + 1)
    high, at = _as_sql(lines, at + 1)  # past the line of Else
    return f"CASE WHEN c.{FEATURES[int(m[1])]} <= {float(m[2])!r}D THEN {low} ELSE {high} END", at


def trees_sql(printed: str) -> str:
    """The score, 0 to 1, of boosted trees as a SQL expression over a candidate ``c``."""
    lines, parts, at = printed.split("\n"), [], 0
    while at < len(lines):
        if m := re.match(r"\s*Tree \d+ \(weight (\S+)\):", lines[at]):
            expr, at = _as_sql(lines, at + 1)
            parts.append(f"{float(m[1])!r}D * ({expr})")
        else:
            at += 1
    return f"1D / (1D + exp(-2D * ({' + '.join(parts)})))"


class Detector:
    """Score expression and thresholds by kind; without trees nothing is added."""

    def __init__(self, score: str | None, threshold: dict[str, float]):
        self.score, self.threshold = score, threshold

    def added(self) -> Column:
        """Candidates of no label that reach their kind's threshold, without those inside another: array of (k, b, e)."""
        if self.score is None:
            return F.array().cast("array<struct<k:int,b:int,e:int>>")
        bound = "CASE c.k " + " ".join(f"WHEN {i} THEN {self.threshold[k]!r}D" for i, k in enumerate(KINDS)) + " END"
        chosen = F.expr(f"filter(candidates, c -> c.label IS NULL AND {self.score} >= {bound})")
        base = {k: F.col(f"base_{k}") for k in KINDS}
        new = F.array_distinct(F.transform(chosen, lambda c: F.struct(c["k"].alias("k"), c["b"].alias("b"), c["e"].alias("e"))))
        inner = lambda c: F.exists(new, lambda d: (d["k"] == c["k"]) & (d["b"] <= c["b"]) & (d["e"] >= c["e"]) & (d != c))
        return F.filter(F.filter(new, lambda c: ~inner(c)), lambda c: ~F.coalesce(*[F.when(c["k"] == i, F.exists(base[k], lambda x: (x["b"] == c["b"]) & (x["e"] == c["e"])))
                                                     for i, k in enumerate(KINDS)]))


def _labelled(docs: DataFrame, text: str) -> DataFrame:
    """All labelled candidates of all texts: rows of one kind, label, half and features are one, ``n`` of them."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    some = docs.select(t.alias("t")).withColumn("held", F.pmod(F.xxhash64("t"), F.lit(1_000_000)) % 5 == 0)
    some = with_candidates(some, "t").select("held", F.explode(F.filter("candidates", lambda c: c["label"] < 2)).alias("c"))
    rows = some.select("held", "c.k", "c.label", *[f"c.{f}" for f in FEATURES])
    return rows.groupBy("held", "k", "label", *FEATURES).agg(F.count("*").alias("n"))


def _thresholds(scored: DataFrame, precision: float) -> dict[str, float]:
    """By kind, the least score of 0.5 or more at which the share of positives among the rows of (k, label, n, s)
    that reach it is ``precision`` or more; 2 (out of reach) where there is none.

    Running sums go over the scores of a small range each, and over the ranges, so no window holds all scores of a kind."""
    each = scored.where("s >= 0.5").groupBy("k", F.floor(F.col("s") * RANGES).alias("part"), "s").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("good"))
    above = Window.partitionBy("k").orderBy(F.col("part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    parts = each.groupBy("k", "part").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).select(
        "k", "part", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"above_{c}") for c in ("n", "good")])
    inside = Window.partitionBy("k", "part").orderBy(F.col("s").desc())
    sums = each.join(parts, ["k", "part"]).select("k", "s", *[(F.sum(c).over(inside) + F.col(f"above_{c}")).alias(c) for c in ("n", "good")])
    found = {r["k"]: r["s"] for r in sums.where(F.col("good") >= precision * F.col("n")).groupBy("k").agg(F.min("s").alias("s")).collect()}
    return {k: float(found.get(i, 2.0)) for i, k in enumerate(KINDS)}


def fit(docs: DataFrame, precision: float = 0.99, rounds: int = 12, depth: int = 3, text: str = "text") -> Detector:
    """Trees and thresholds from the candidates of all documents; equal ones are one row that weighs as many."""
    rows = stored(_labelled(docs, text), "candidates")
    train = rows.where("not held")
    if len(train.select("label").distinct().take(2)) < 2:
        return Detector(None, {})
    data = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(train.orderBy("k", "label", *FEATURES))
    data = data.select("x", F.col("label").cast("double").alias("y"), F.col("n").cast("double").alias("n"))
    model = GBTClassifier(labelCol="y", featuresCol="x", weightCol="n", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=3, maxBins=32).fit(data)
    score = trees_sql(model.toDebugString)
    held = rows.where("held").select("k", "label", "n", F.struct(*FEATURES).alias("c")).select("k", "label", "n", F.expr(score).alias("s"))
    return Detector(score, _thresholds(held, precision))


def detect(docs: DataFrame, detector: Detector, text: str = "text") -> DataFrame:
    """``docs`` with ``base_<kind>`` arrays, ``added`` (k, b, e) and ``spans``: all as (b, k, e), by start, then kind."""
    out = with_candidates(docs, text) if detector.score else with_base(docs, text)
    out = out.withColumn("added", detector.added()).drop("candidates")
    return out.withColumn("spans", F.array_sort(F.concat(base_list(), F.transform("added", lambda c: F.struct(c["b"], c["k"], c["e"])))))


def base_list() -> Column:
    """All base spans as (b, k, e)."""
    def of(i: int, kind: str) -> Column:
        return F.transform(f"base_{kind}", lambda s: F.struct(s["b"].alias("b"), F.lit(i).alias("k"), s["e"].alias("e")))

    return F.concat(*[of(i, k) for i, k in enumerate(KINDS)])


def written(spans: Column) -> Column:
    """``kind:start:end`` of spans (b, k, e), joined by commas in their order."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["k"]), s["b"], s["e"])), ",")


def digest(docs: DataFrame, detector: Detector) -> DataFrame:
    """doc_id, numbers of base spans by kind, base_sha256, and all spans as a string."""
    found = detect(docs.select("doc_id", "text"), detector)
    return found.select("doc_id", *[F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(written(F.array_sort(base_list())), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, detector: Detector, text: str = "text") -> DataFrame:
    """``docs``, any columns, with every span replaced by its kind in brackets; spans that overlap become one.

    An ``n_chars`` column counts the new text.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = detect(docs.select(row.alias("__row"), F.col(text).cast("string").alias("__text")), detector, "__text")
    t = F.col("__text")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        piece = F.array(F.substring(t, s["at"] + 1, F.greatest(x["b"] - s["at"], F.lit(0))), F.get(names, x["k"]))
        return F.struct(F.greatest(s["at"], x["e"]).alias("at"), F.when(x["b"] >= s["at"], F.concat(s["out"], piece)).otherwise(s["out"]).alias("out"))

    whole = F.aggregate("spans", start, step, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(t, s["at"] + 1, F.length(t))))
    new = found.select("__row", F.when(F.size("spans") > 0, whole).otherwise(t).alias("__text"))
    put = {text: F.col("__text"), "n_chars": F.length("__text").cast("long")}
    return new.select(*[put[c].alias(c) if c in put else F.col("__row").getField(c).alias(c) for c in docs.columns])
