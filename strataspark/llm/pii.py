"""Personal data by candidate gradient boosting (DataFrame functions and Spark ML only)."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
WIDE_KINDS = [*KINDS, "secret"]  # access keys have no base format: only generators propose them
# The base formats. Quantifiers are possessive and matches begin at the start of a
# run (or where the last match ended), which finds the same spans in linear time and without
# recursion on very long runs.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# High-recall generators of further candidates; they overlap each other and the base spans. Runs are taken whole, whatever their length; the trees judge it.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20?[\[(]at[\])]\x20?|\x20at\x20)[A-Za-z0-9-]++(?:(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20|\.)[A-Za-z0-9-]{2,}+)++",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){3,7}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9A-Za-z.])[0-9]{4}(?:[._/\x20-]{1,2}[0-9]{4}){2}[._/\x20-]{1,2}[0-9]{1,7}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z.+])\(?[0-9]{2,4}\)?(?:[\x20./-]{1,2}[0-9]{2,6}+(?![0-9A-Za-z]))++",
}
WIDE["secret"] = r"(?<![0-9A-Za-z_])(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key|auth)\x20?[:=]\x20?[\x22']?[A-Za-z0-9+/_-]{8,}+"
GATE = {"secret": r"(?i)(?:token|secret|passw|key|auth)[^\n]{0,8}[:=]",
        "email": r"[\[(]at[\])]|\x20at\x20[A-Za-z0-9-]++(?:\x20dot\x20|\x20?[\[(]dot|\.[A-Za-z0-9])", "ip": ":[0-9A-Fa-f]{1,4}:", "card": "[0-9]", "phone": "[0-9]"}
CUES = {
    "email": r"e-?mail|mail|contact|write|reach", "ip": r"\bip\b|address|server|host|addr",
    "card": r"card|visa|mastercard|credit|payment|amex", "phone": r"phone|tel|call|mobile|cell|fax|contact", "secret": r"config|login|header|export|set|env",
}
CONTEXT, RUN = 32, 256
FEATURES = ["kind", "length", "digits", "letters", "separators", "groups", "longest", "luhn", "cue", "foreign", "glued", "dotted", "spelled", "mixed"]
TRAIN_ROWS, TREES, DEPTH, PRECISION = 6000, 12, 3, 0.95

SPANS = "array<struct<start:int,stop:int,hit:string>>"


def empty() -> Column:
    return F.array().cast(SPANS)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    worth = lambda i: F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")  # noqa: E731  i-th from the right
    each = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), lambda i: F.when(i % 2 == 0, worth(i)).otherwise(
        worth(i) * 2 - F.when(worth(i) > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def only_digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def located(text: Column, pattern: str) -> Column:
    """All matches with their places in code points: the text splits into pieces between matches,
    whose lengths and the matches' own add up to the places."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    step = F.zip_with(F.slice(pieces, F.lit(1), F.size(hits)), hits,
                      lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")))
    zero = F.struct(F.lit(0).alias("at"), empty().alias("spans"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        stop = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), stop.alias("stop"), x["hit"].alias("hit"))
        return F.struct(stop.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    # places within blocks of RUN matches, then the blocks' own: an array is copied with each match, so blocks keep that short
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / RUN)), lambda b: F.aggregate(F.slice(step, (b * RUN + 1).cast("int"), F.lit(RUN)), zero, add))
    begins = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("of")), lambda acc, b: F.struct(
        (acc["at"] + b["at"]).alias("at"), F.concat(acc["of"], F.array(acc["at"])).alias("of")), lambda acc: acc["of"])
    moved = F.flatten(F.zip_with(blocks, begins, lambda b, o: F.transform(b["spans"], lambda s: F.struct(
        (s["start"] + o).alias("start"), (s["stop"] + o).alias("stop"), s["hit"].alias("hit")))))
    return F.when(F.size(hits) > RUN, moved).when(F.size(hits) > 0, F.aggregate(step, zero, add, lambda acc: acc["spans"])).otherwise(empty())


def valid(kind: str, hit: Column) -> Column:
    """Whether a match of the base format counts."""
    digits = only_digits(hit)
    n = F.length(digits)
    if kind == "ip":
        part = lambda p: F.length(F.regexp_replace(p, "^0+", ""))
        return F.forall(F.split(hit, "\\."), lambda p: (part(p) == 0) | (
            (part(p) <= 3) & (F.regexp_replace(p, "^0+(?=[0-9])", "").try_cast("int") <= 255)))
    if kind == "card":
        return F.when(n.between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str, fits: Column) -> Column:
    """Spans of a base format; ``fits`` spares texts that cannot hold one."""
    return F.when(fits, F.filter(located(text, BASE[kind]), lambda s: valid(kind, s["hit"]))).otherwise(empty())


def features(kind: str, hit: Column, before: Column, after: Column) -> dict[str, Column]:
    """Format and context features of one candidate."""
    digits = only_digits(hit)
    runs = F.filter(F.split(hit, "[^0-9]+"), lambda p: p != "")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    values = {
        "kind": F.lit(float(WIDE_KINDS.index(kind))), "length": F.length(hit), "digits": F.length(digits),
        "letters": F.length(F.regexp_replace(hit, "[^A-Za-z]", "")),
        "separators": F.length(F.regexp_replace(hit, "[0-9A-Za-z]", "")), "groups": F.size(runs),
        "longest": F.coalesce(F.array_max(F.transform(runs, lambda p: F.length(p))), F.lit(0)),
        "luhn": flag(F.when(F.length(digits).between(13, 19), luhn(digits))),
        "cue": flag(F.lower(before).rlike(CUES[kind])),
        "foreign": flag(F.lower(before).rlike(r"version|order|invoice|isbn|page|date|serial|total|price|\bid\b|chapter|score|since|from")),
        "glued": flag(before.rlike("[0-9A-Za-z_=#\"]$") | after.rlike("^[0-9A-Za-z_\"]")),
        "dotted": flag(hit.contains(".")), "spelled": flag(hit.rlike(r"\bdot\b|[\[(]at[\])]")),
        "mixed": flag(hit.rlike("[0-9][A-Za-z]+[0-9]|[A-Za-z][0-9]+[A-Za-z]")),
    }
    return {k: v.cast("double") for k, v in values.items()}


def training_rows(spark: SparkSession, rows: int) -> DataFrame:
    """Labelled candidates (kind, before, hit, after, label), generated from row numbers: true ones in the
    formats that the generators propose, false ones that look alike (dates, prices, versions, codes)."""
    r = lambda k: F.pmod(F.xxhash64(F.col("id"), F.lit(k)), F.lit(10000)).cast("int")
    d = lambda k, n: F.lpad(F.pmod(F.xxhash64(F.col("id"), F.lit(k), F.lit("d")), F.lit(10 ** n)).cast("string"), n, "0")
    pick = lambda k, *xs: F.element_at(F.array(*[F.lit(x) if isinstance(x, str) else x for x in xs]), r(k) % len(xs) + 1)
    word = pick(1, "alder", "brook", "cedar", "delta", "ember", "fjord", "grove", "heron")
    sep = pick(2, " ", "-", ".", "/")
    first15 = F.concat(pick(3, "4", "51", "37", "6011"), d(4, 14)).substr(1, 15)
    check = F.element_at(F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda x: F.concat(first15, x.cast("string"))), luhn), 1)
    cases = [  # kind, label, hit
        ("email", 1, F.concat(word, pick(5, " at ", " [at] ", "(at)"), word, pick(6, " dot ", " [dot] ", "(dot)"), pick(7, "com", "org", "net"))),
        ("email", 0, F.concat(word, F.lit(" at "), word, F.lit("."), pick(7, "The", "And", "com"))),
        ("ip", 1, F.concat_ws(":", *[F.lower(F.hex(r(k))) for k in (8, 9, 10, 11, 12, 13, 14, 15)])),
        ("ip", 0, F.concat_ws(":", d(16, 2), d(17, 2), d(18, 2), d(19, 2))),
        ("card", 1, F.concat(F.substring(check, 1, 4), sep, F.substring(check, 5, 4), sep, F.substring(check, 9, 4), sep, F.substring(check, 13, 4))),
        ("card", 0, F.concat(d(20, 4), sep, d(21, 4), sep, d(22, 4), sep, d(23, 4))),
        ("phone", 1, F.concat(F.lit("("), d(24, 3), F.lit(") "), d(25, 3), pick(26, "-", " ", "."), d(27, 4))),
        ("phone", 1, F.concat(d(24, 3), sep, d(25, 3), sep, d(27, 4))),
        ("phone", 0, F.concat(d(28, 2), sep, d(29, 2), sep, d(30, 4))),
        ("phone", 0, F.concat(d(31, 2), F.lit("."), d(32, 2))),
        ("phone", 0, F.concat(d(33, 4), F.lit(" "), d(34, 4))),
        ("secret", 1, F.concat(pick(39, "token", "api_key", "secret", "access-key"), pick(40, " = \"", "=", ": ", "='"), F.substring(F.sha2(d(41, 9), 256), 1, 20 + r(42) % 30))),
        ("secret", 1, F.concat(pick(39, "token", "password", "passwd", "auth"), pick(40, " = \"", "=", ": ", "='"), F.substring(F.base64(F.sha2(d(43, 9), 256).cast("binary")), 2, 12 + r(44) % 20))),
        ("secret", 0, F.concat(pick(39, "token", "secret", "password", "auth"), pick(40, ": ", ":", " = ", "="), pick(45, "required", "authentication", "optional", "something", "nextsection", "undefined"))),
    ]
    frame = spark.range(rows).withColumn("case", (r(35) % len(cases)))
    choose = lambda f: reduce(lambda acc, k: F.when(F.col("case") == k, f(cases[k])).otherwise(acc), range(1, len(cases)), f(cases[0]))
    cue = {"email": "email ", "ip": "ip address ", "card": "card ", "phone": "call ", "secret": "config "}
    true_before = choose(lambda c: F.lit(cue[c[0]]))
    return frame.select(
        choose(lambda c: F.lit(c[0])).alias("kind"), choose(lambda c: F.lit(float(c[1]))).alias("label"), choose(lambda c: c[2]).alias("hit"),
        # a true one mostly has a cue before it, a false one mostly something else
        F.when((choose(lambda c: F.lit(c[1])) == 1) & (r(36) < 8500), true_before)
        .otherwise(pick(37, "version ", "order ", "since ", "page ", "the ", "total ")).alias("before"),
        pick(38, " the", ".", ",", " of").alias("after"))


def tree_column(node, values: list[Column]) -> Column:
    """A regression tree as a nested conditional."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    test = values[split.featureIndex()] <= float(split.threshold())
    return F.when(test, tree_column(node.leftChild(), values)).otherwise(tree_column(node.rightChild(), values))


class Booster:
    """Boosted trees over candidates, and for each kind the margin from which a candidate is redacted."""

    def __init__(self, trees: list, weights: list[float], cutoffs: dict[str, float]):
        self.trees, self.weights, self.cutoffs = trees, weights, cutoffs

    def margin(self, values: dict[str, Column]) -> Column:
        order = [values[n] for n in FEATURES]
        return sum((F.lit(float(w)) * tree_column(t, order) for t, w in zip(self.trees, self.weights)), F.lit(0.0))


def fit(spark: SparkSession, rows: int = TRAIN_ROWS) -> Booster:
    """Fit on generated candidates (a bounded number of rows, the parameter): two thirds for the trees,
    a third to set each kind's cutoff at the least margin whose precision from there on is PRECISION."""
    made = training_rows(spark, rows)
    cols = []
    for name in FEATURES:
        cols.append(reduce(lambda acc, k: F.when(F.col("kind") == k, features(k, F.col("hit"), F.col("before"), F.col("after"))[name]).otherwise(acc),
                           WIDE_KINDS[1:], features(WIDE_KINDS[0], F.col("hit"), F.col("before"), F.col("after"))[name]).alias("f_" + name))
    table = made.select("label", F.col("kind").alias("k"), F.pmod(F.xxhash64("hit", "before"), F.lit(3)).alias("fold"), *cols).coalesce(1).cache()
    ready = VectorAssembler(inputCols=["f_" + n for n in FEATURES], outputCol="features").transform(table)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7).fit(ready.filter("fold < 2"))
    booster = Booster([t._java_obj.rootNode() for t in model.trees], list(model.treeWeights), {})
    held = table.filter("fold = 2").select("k", "label", F.round(booster.margin({n: F.col("f_" + n) for n in FEATURES}), 6).alias("m"))
    steps = held.groupBy("k", "m").agg(F.sum("label").alias("hits"), F.count(F.lit(1)).alias("n")).collect()
    for kind in WIDE_KINDS:  # at most as many rows as TRAIN_ROWS / 3
        hits = n = 0.0
        cut = float("inf")
        for s in sorted((s for s in steps if s.k == kind), key=lambda s: -s.m):
            hits, n = hits + s.hits, n + s.n
            cut = s.m if hits / n >= PRECISION else cut
        booster.cutoffs[kind] = cut
    table.unpersist()
    return booster


def wide_spans(text: Column, kind: str, fits: Column, booster: Booster) -> Column:
    """Proposed candidates that the trees accept."""
    def accepted(s: Column) -> Column:
        before = F.substring(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT)))
        after = F.substring(text, s["stop"] + 1, F.lit(4))
        return booster.margin(features(kind, s["hit"], before, after)) >= booster.cutoffs[kind]

    return F.when(fits, F.filter(located(text, WIDE[kind]), accepted)).otherwise(empty())


def find_pii(docs: DataFrame, booster: Booster | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data of every text: (id, email, ip, card, phone, extra).

    The four arrays hold the base spans (struct<start, stop, hit>, code points, end exclusive). ``extra``
    holds further spans (with ``kind``, also of access keys, kind ``secret``): wider generators propose candidates that may overlap, boosted trees
    score format and context, and those from the calibrated cutoff of their kind on stay unless they overlap
    a base span. One narrow projection without shuffle: each text is looked at where it lies, and texts
    without digits or ``@`` are passed over by cheap tests. Null texts count as empty; every row gives one row.
    """
    model = booster or fit(docs.sparkSession)
    t = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    t = t.select("id", "t", F.col("t").contains("@").alias("has_at"), F.col("t").rlike("[0-9]").alias("has_digit"))
    text = F.col("t")
    fits = {"email": F.col("has_at"), "ip": F.col("has_digit") & text.contains("."), "card": F.col("has_digit") & text.rlike("[0-9](?:[\\x20-]?[0-9]){12}"),
            "phone": F.col("has_digit") & text.contains("+")}
    found = t.select("id", "t", "has_digit", *[base_spans(text, k, fits[k]).alias(k) for k in KINDS])
    may = {k: text.rlike(GATE[k]) & (F.lit(True) if k in ("email", "ip", "secret") else F.col("has_digit")) for k in WIDE_KINDS}
    found = found.select("id", *KINDS, *[wide_spans(text, k, may[k], model).alias("w_" + k) for k in WIDE_KINDS])
    base = F.concat(*[F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))) for k in KINDS])
    found = found.select("id", *KINDS, *["w_" + k for k in WIDE_KINDS], base.alias("all"))
    clear = lambda s: ~F.exists("all", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
    tag = lambda k: lambda s: F.struct(F.lit(k).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["hit"].alias("hit"))
    tagged = F.concat(*[F.transform(F.filter("w_" + k, clear), tag(k)) for k in WIDE_KINDS])
    return found.select("id", *KINDS, tagged.alias("extra"))


def span_text(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["stop"].cast("string")))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and all spans as text (those of further kinds last), of a result of ``find_pii``."""
    base = F.array_join(F.concat(*[span_text(k, F.col(k)) for k in KINDS]), ",")
    of = lambda k: F.transform(F.filter("extra", lambda s: s["kind"] == k), lambda s: F.struct(
        s["start"].alias("start"), s["stop"].alias("stop"), s["hit"].alias("hit")))
    every = lambda k: F.concat(F.col(k), of(k)) if k in KINDS else of(k)
    both = F.array_join(F.concat(*[span_text(k, F.array_sort(every(k))) for k in WIDE_KINDS]), ",")
    total = sum((F.size(k) for k in KINDS), F.size("extra")).cast("long")
    return found.select(F.col("id").alias("doc_id"), *[F.size(k).cast("long").alias("n_" + k) for k in KINDS],
                        F.sha2(base, 256).alias("base_sha256"), both.alias("spans"), F.size("extra").cast("long").alias("n_extra"), total.alias("n_spans"))
