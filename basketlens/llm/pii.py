"""Personal data by candidate gradient boosting, in Spark's own functions only.

Base spans (emails, IP addresses, card and phone numbers) are found by fixed patterns and rules and
always stay. Beside them, wider generators propose overlapping candidates: anything around an "@",
spelled-out addresses, runs of digits with any of the usual separators, dotted numbers. Boosted
trees score every candidate by its format (length, digits, groups, separators) and its context
(the characters around it); they never see the rules. They learn from the candidates of all
documents, labelled by whether a base span covers the candidate exactly, so that they
recognise what looks and stands like personal data though it breaks a rule. For each kind the
lowest threshold with enough precision on candidates kept from training is chosen
(``PRECISION``); candidates from there on that touch no base span are added, longer ones first
where two start together.

The trees are Spark ML's. They are applied as plain column expressions inside each row, so every
document is handled by itself in one pass: nothing is shuffled and no row is identified by its id.
Null texts count as empty ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.native import MARK, below, cut, let, matches, pieces, running

TREES, DEPTH = 16, 3
LEAST = 5  # candidates on either side of a split
PRECISION = 0.95
KINDS = ("email", "ip", "card", "phone")
#: The base patterns. They match what
#:   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#:   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#:   card   [0-9]([\x20-]?[0-9])+
#:   phone  \+[0-9][\x20().0-9-]+[0-9]
#: match, written so that long runs are neither read again from each start nor held on the stack.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What must be in a text for a pattern to be tried.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
GENERATORS = {
    "email": r"(?<![^\s<>\"'(),;:|])[^\s<>\"'(),;:|@]{1,64}+(?:@|\x20?[(\[]at[)\]]\x20?)[^\s<>\"'(),;:|@]{2,128}",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:[.:][0-9]{1,3}+){3,7}+",
    "number": r"(?<![0-9A-Za-z])\+?+[0-9(](?:[\x20().\-/]{0,2}[0-9]){6,24}+(?![0-9A-Za-z])",
}
SPAN = "struct<kind: string, start: int, stop: int, value: string>"
FEATURES = (
    "length", "digits", "letters", "groups", "longest_group", "plus", "bracket", "hyphens", "dots", "blanks",
    "at", "mixed", "blank_before", "blank_after", "letter_before", "digit_before", "sign_before", "line_before",
)


def _luhn(digits: Column) -> Column:
    """Whether the check sum of a text of digits is right."""
    places = F.sequence(F.lit(1), F.length(digits))

    def value(place: Column) -> Column:
        digit = F.substring(digits, place, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when((F.length(digits) - place) % 2 == 1, twice).otherwise(digit)

    return F.aggregate(places, F.lit(0), lambda total, place: total + value(place)) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(
            F.split(value, r"\."),
            lambda part: let(
                F.ltrim(part, F.lit("0")),
                lambda p: (F.length(p) <= 3) & (F.when(F.length(p) <= 3, F.coalesce(p.try_cast("int"), F.lit(0))) <= 255),
            ),
        )
    if kind == "card":
        return let(_digits(value), lambda d: F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(F.lit(False)))
    return F.length(_digits(value)).between(9, 15)


def _no_spans() -> Column:
    return F.expr(f"cast(array() as array<{SPAN}>)")


def _named(kind: Column, span: Column) -> Column:
    return F.struct(
        kind.alias("kind"), span["start"].alias("start"), span["stop"].alias("stop"), span["value"].alias("value")
    )


def base_spans(text: Column, kind: str) -> Column:
    """The valid matches of one kind, from left to right."""
    found = F.transform(
        F.filter(matches(text, PATTERNS[kind]), lambda span: _valid(kind, span["value"])),
        lambda span: _named(F.lit(kind), span),
    )
    need = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else text.rlike("[0-9][\\x20-]?[0-9]")
    return F.when(need, found).otherwise(_no_spans())


def _count(value: Column, character: str) -> Column:
    return F.length(value) - F.length(F.replace(value, F.lit(character), F.lit("")))


def _features(parts: Column, span: Column) -> Column:
    """Format and context of a candidate, an array in the order of :data:`FEATURES`; ``parts`` are the text's pieces."""
    value = span["value"]
    before = cut(parts, span["start"] - 1, span["start"])
    before = F.when(span["start"] == 0, F.lit("\n")).otherwise(before)
    behind = cut(parts, span["stop"], span["stop"] + 1)
    group = F.split(F.trim(F.regexp_replace(value, "[^0-9]+", " ")), " ")
    digits = F.length(_digits(value))
    letters = F.length(F.regexp_replace(value, r"\P{L}+", ""))
    front = cut(parts, F.greatest(span["start"] - 12, F.lit(0)), span["start"])
    numbers = (
        F.length(value), digits, letters, F.size(group), F.array_max(F.transform(group, F.length)),
        value.startswith("+"), _count(value, "("), _count(value, "-"), _count(value, "."), _count(value, " "),
        _count(value, "@"), (digits > 0) & (letters > 0), before.rlike(r"\s"),
        behind.rlike(r"\s") | (behind == ""), before.rlike(r"\p{L}"), before.rlike("[0-9]"),
        front.rlike("[=:\"']"), F.contains(front, F.lit("\n")) | (span["start"] == 0),
    )
    return F.array(*[F.coalesce(n.cast("double"), F.lit(0.0)) for n in numbers])


def candidate_spans(text: Column) -> Column:
    """What the generators propose, overlaps and all; numbers are cards from 13 digits on."""

    def proposed(name: str, pattern: str) -> Column:
        def named(span: Column) -> Column:
            card = F.when(F.length(_digits(span["value"])) >= 13, "card").otherwise("phone")
            return _named(card if name == "number" else F.lit(name), span)

        need = text.rlike(r"@|[(\[]at[)\]]") if name == "email" else text.rlike("[0-9]")
        return F.when(need, F.transform(matches(text, pattern), named)).otherwise(_no_spans())

    return F.concat(*[proposed(name, pattern) for name, pattern in GENERATORS.items()])


def _clean(text: Column) -> Column:
    """The text with the mark that :func:`matches` needs replaced by its neighbour."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit("\x02"))


def with_base(docs: DataFrame, text: str, prefix: str) -> DataFrame:
    """``docs`` with the cleaned text and the base spans of each kind, in columns of this prefix."""
    docs = docs.withColumn(f"{prefix}text", _clean(F.col(text)))
    return docs.withColumns({f"{prefix}{kind}": base_spans(F.col(f"{prefix}text"), kind) for kind in KINDS})


class Scorer:
    """The trees as column expressions and the threshold of each kind."""

    def __init__(self, trees: list, thresholds: dict[str, float]):
        self.trees = trees
        self.thresholds = thresholds

    def margin(self, features: Column) -> Column:
        def walk(node) -> Column:
            if len(node) == 1:
                return F.lit(node[0])
            feature, threshold, left, right = node
            return F.when(features[feature] <= threshold, walk(left)).otherwise(walk(right))

        return reduce(lambda a, b: a + b, [F.lit(weight) * walk(tree) for weight, tree in self.trees])

    def accepted(self, kind: Column, features: Column) -> Column:
        probability = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * self.margin(features)))
        limit = reduce(
            lambda rest, k: F.when(kind == k, F.lit(self.thresholds[k])).otherwise(rest), self.thresholds, F.lit(2.0)
        )
        return probability >= limit


def _tree(node) -> tuple:
    if node.subtreeDepth() == 0:
        return (float(node.prediction()),)
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", most: int | None = None) -> Scorer | None:
    """Trees and thresholds from every text, or with ``most`` from at most so many documents, picked by a hash of their key.

    Candidates that look alike are counted first, and the trees learn from the counts: these are as many as there are
    different formats and contexts, however many documents. Rows that share a key or have none all count. With ``most``, of
    rows that share a key the text with the smallest hash is taken, so the bound is one on rows, and null keys are left out.
    Null texts have no candidates. None if all candidates are covered by base spans, or none is.
    """
    texts = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).where(F.col("__text").isNotNull())
    if most is not None:
        keys = docs.select(F.col(key).alias("__key")).where(F.col("__key").isNotNull()).distinct()
        picked = keys.orderBy(F.xxhash64("__key"), "__key").limit(most)
        texts = texts.join(F.broadcast(picked), "__key").groupBy("__key").agg(
            F.min_by("__text", F.xxhash64("__text")).alias("__text")
        )
    sample = with_base(texts.where(F.col("__text").rlike("[0-9@]")), "__text", "__b_")

    def place(span: Column) -> Column:
        return F.shiftleft(span["start"].cast("bigint"), 31) + span["stop"]

    def labelled(parts: Column, known: Column, span: Column) -> Column:
        whole = F.coalesce(F.get(known, below(known, place(span))) == place(span), F.lit(False))
        return F.struct(
            span["kind"].alias("kind"),
            span["start"].alias("start"),
            _features(parts, span).alias("f"),
            whole.cast("double").alias("label"),
        )

    known = F.array_sort(F.transform(F.concat(*[F.col(f"__b_{kind}") for kind in KINDS]), place))
    plain = F.col("__b_text")
    labels = let(
        F.struct(pieces(plain).alias("parts"), known.alias("known")),
        lambda seen: F.transform(candidate_spans(plain), lambda span: labelled(seen["parts"], seen["known"], span)),
    )
    rows = sample.select("__key", F.explode(labels).alias("__span")).select("__key", "__span.*")
    names = [f"f{i}" for i in range(len(FEATURES))]
    kept = (F.pmod(F.xxhash64("__key"), F.lit(10)) < 3).alias("kept")
    rows = rows.select(kept, "kind", "label", *[F.col("f")[i].alias(n) for i, n in enumerate(names)])
    rows = rows.groupBy("kept", "kind", "label", *names).agg(F.count(F.lit(1)).cast("double").alias("many"))
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(rows).cache()
    try:
        seen = {(r["kept"], r["label"]): r["many"] for r in rows.groupBy("kept", "label").agg(F.sum("many").alias("many")).collect()}
        if not {(False, 0.0), (False, 1.0)} <= seen.keys():
            return None
        total = seen[(False, 0.0)] + seen[(False, 1.0)]
        boosted = GBTClassifier(
            labelCol="label", weightCol="many", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxBins=64,
            minInstancesPerNode=1, minWeightFractionPerNode=min((LEAST - 0.5) / total, 0.499),
        )
        model = boosted.fit(rows.where(~F.col("kept")))
        probability = vector_to_array("probability")[1]
        by_step = (
            model.transform(rows.where("kept"))
            .groupBy("kind", F.floor(probability * 100).cast("int").alias("step"))
            .agg(F.sum(F.col("label") * F.col("many")).alias("right"), F.sum("many").alias("all"))
            .collect()
        )
    finally:
        rows.unpersist()
    thresholds = {}
    for kind in KINDS:
        right = everything = 0.0
        for r in sorted((r for r in by_step if r["kind"] == kind), key=lambda r: -r["step"]):
            right, everything = right + r["right"], everything + r["all"]
            if right >= PRECISION * everything:
                thresholds[kind] = max(r["step"] / 100, 0.5)
    if not thresholds:
        return None
    trees = [(w, _tree(t._call_java("rootNode"))) for w, t in zip(model.treeWeights, model.trees, strict=True)]
    return Scorer(trees, thresholds)


def _untouched(base: Column, candidates: Column) -> Column:
    """The candidates that overlap no base span: of those that begin before its end none reaches beyond its start."""
    ordered = F.array_sort(F.transform(base, lambda b: F.struct(b["start"].alias("start"), b["stop"].alias("stop"))))

    def apart(seen: Column, c: Column) -> Column:
        reach = F.get(seen["reach"], below(seen["starts"], c["stop"]) - 1)
        return F.coalesce(reach <= c["start"], F.lit(True))

    return let(
        ordered,
        lambda b: let(
            F.struct(
                F.transform(b, lambda s: s["start"]).alias("starts"),
                running(F.transform(b, lambda s: s["stop"]), F.greatest).alias("reach"),
            ),
            lambda seen: F.filter(candidates, lambda c: apart(seen, c)),
        ),
    )


def _in_a_row(spans: Column) -> Column:
    """Of spans in order, each that starts behind the last one taken.

    They are taken block by block, about as many blocks as spans in each, so that no list is copied for every span.
    """
    block = F.ceil(F.sqrt(F.size(spans))).cast("int")

    def one(done: Column, c: Column) -> Column:
        free = done["at"] <= c["start"]
        return F.struct(
            F.when(free, c["stop"]).otherwise(done["at"]).alias("at"),
            F.when(free, F.concat(done["taken"], F.array(c))).otherwise(done["taken"]).alias("taken"),
        )

    def several(done: Column, number: Column) -> Column:
        part = F.slice(spans, number * block + 1, block)
        start = F.struct(done["at"].alias("at"), _no_spans().alias("taken"))
        return let(
            F.aggregate(part, start, one),
            lambda new: F.struct(
                new["at"].alias("at"), F.concat(done["blocks"], F.array(new["taken"])).alias("blocks")
            ),
        )

    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<array<{SPAN}>>)").alias("blocks"))
    taken = F.aggregate(F.sequence(F.lit(0), block - 1), start, several, lambda done: F.flatten(done["blocks"]))
    return F.when(F.size(spans) > 0, taken).otherwise(_no_spans())


def with_spans(docs: DataFrame, scorer: Scorer | None, text: str = "text", prefix: str = "__b_") -> DataFrame:
    """``with_base`` and ``<prefix>added``: accepted candidates that touch no base span or each other."""
    docs = with_base(docs, text, prefix)
    if scorer is None:
        return docs.withColumn(f"{prefix}added", _no_spans())
    plain = F.col(f"{prefix}text")
    base = F.concat(*[F.col(f"{prefix}{kind}") for kind in KINDS])
    docs = docs.withColumn(f"{prefix}open", _untouched(base, candidate_spans(plain)))
    good = let(
        pieces(plain),
        lambda parts: F.filter(
            F.col(f"{prefix}open"), lambda c: let(_features(parts, c), lambda f: scorer.accepted(c["kind"], f))
        ),
    )
    order = F.transform(
        good,
        lambda c: F.struct(c["start"].alias("start"), (-c["stop"]).alias("back"), c["kind"].alias("kind"), c["value"].alias("value")),
    )
    spans = F.transform(
        F.array_sort(order),
        lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), (-c["back"]).alias("stop"), c["value"].alias("value")),
    )
    added = let(spans, _in_a_row)
    return docs.withColumn(f"{prefix}added", F.when(F.size(f"{prefix}open") > 0, added).otherwise(_no_spans()))


def _printed(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
        ),
        ",",
    )


def _reordered(spans: Column, *fields: str) -> Column:
    return F.transform(spans, lambda s: F.struct(*[s[field].alias(field) for field in fields]))


def _by_kind(prefix: str, added: bool) -> Column:
    """The spans by kind as listed, then by start."""

    def of(kind: str) -> Column:
        own = F.col(f"{prefix}{kind}")
        if not added:
            return own
        both = F.concat(own, F.filter(f"{prefix}added", lambda s: s["kind"] == kind))
        ordered = F.array_sort(_reordered(both, "start", "stop", "kind", "value"))
        return _reordered(ordered, "kind", "start", "stop", "value")

    return F.concat(*[of(kind) for kind in KINDS])


def pii_report(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``.

    doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256 (of kind:start:end of the base
    spans), spans (kind:start:end of all spans), n_added.
    """
    found = with_spans(docs.select("doc_id", "text"), train(docs))
    return found.select(
        "doc_id",
        *[F.size(f"__b_{kind}").cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_printed(_by_kind("__b_", False)), 256).alias("base_sha256"),
        _printed(_by_kind("__b_", True)).alias("spans"),
        F.size("__b_added").cast("bigint").alias("n_added"),
    )


def redacted(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in square brackets.

    Where base spans of different kinds overlap, their union is replaced by the first one's kind.
    Everything outside the spans, and texts without spans, nulls included, stay as they are.
    """
    columns = docs.columns
    prefix = "__b_"
    while any(name.lower().startswith(prefix) for name in columns):
        prefix = "_" + prefix
    found = with_spans(docs, train(docs, key, text), text, prefix)
    every = F.concat(*[F.col(f"{prefix}{kind}") for kind in KINDS], F.col(f"{prefix}added"))
    order = F.array_sort(
        F.transform(
            every, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))
        )
    )
    plain = F.col(text)  # as long as the cleaned text, so positions are the same

    def replaced_spans(seen: Column) -> Column:
        """What comes before each span and its name; nothing for one that starts inside those before."""

        def one(span: Column, i: Column) -> Column:
            at = F.when(i == 0, F.lit(0)).otherwise(F.get(seen["reach"], i - 1))
            name = F.concat(cut(seen["parts"], at, span["start"]), F.lit("["), F.upper(span["kind"]), F.lit("]"))
            return F.when(span["start"] >= at, name).otherwise(F.lit(""))

        rest = cut(seen["parts"], F.element_at(seen["reach"], -1), F.length(plain))
        return F.concat(F.transform(seen["spans"], one), F.array(rest))

    new = let(
        order,
        lambda spans: let(
            F.struct(
                spans.alias("spans"),
                running(F.transform(spans, lambda s: s["stop"]), F.greatest).alias("reach"),
                pieces(plain).alias("parts"),
            ),
            replaced_spans,
        ),
    )
    # used twice below, so that Spark never moves it into a Python function that is applied to the text
    out = f"{prefix}out"
    found = found.withColumn(out, F.when(F.size(every) > 0, new).otherwise(F.expr("cast(array() as array<string>)")))
    replaced = F.when(F.size(out) > 0, F.array_join(out, "")).otherwise(F.col(text))
    return found.withColumn(text, replaced).select(*columns)
