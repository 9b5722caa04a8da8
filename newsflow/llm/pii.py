"""Personal data: generators propose spans, boosted trees choose among them. DataFrame functions only.

Base spans follow fixed formats and always stay. Beside them wide patterns propose candidates, which
may overlap; boosted trees score each by its format and its surroundings. They are trained on at most
``sample`` candidates whose class the checks tell, an equal part for each kind and class (those with the
smallest hash of place and document), so no kind is lost where another is far more frequent:
what overlaps a valid base span of its kind, or follows the name of a secret, is personal; what fails
its checksum or range, or is a bare number, is not; the rest teaches nothing. Over all such candidates
that the trees have not seen (of the sample a quarter of each kind and class, and all others), each kind
gets the lowest threshold at which the chosen are right as often as asked.
Chosen candidates that overlap no base span are added; of those that overlap each other the first,
then the likelier.

The trees become one expression, so candidates are found, scored and chosen inside the row: nothing
is exploded or shuffled to find spans. Texts without a digit or an at sign are not searched.

Defined results: a null or empty text has no spans; repeated rows are searched each; without
candidates of both classes to train on nothing is added; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.session import written

KINDS = ("email", "ip", "card", "phone", "secret")
SAMPLE = 20_000  # candidates that train the trees
SALTED = 50  # of these from each salted group
TREES, DEPTH = 12, 3
PRECISION = 0.95
AROUND = 24  # code points of context on either side

# The base formats, written so that no run of characters is read twice: a match starts
# where a run starts or the match before it ended. Single digits fall to the length check.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7})(?![0-9])",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|(?<![0-9])[0-9]{2,4})[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])",
    "secret": r"(?:\b[A-Za-z_]{3,20}+ ?[=:] ?|(?<!\S))(?=\S*[0-9])\S{8,}+",
}
HINTS = (
    r"(?i)(?:pass|pwd|token|secret|api.?key|AKIA)", r"(?i)(?:tel|phone|call|fax|mobil)", r"(?i)(?:mail|contact|write)",
    r"(?i)(?:card|visa|credit|account|iban)", r"(?i)(?:version|licen|isbn|page|figure|chapter)",
)
_SPANS = "array<struct<rank:int,start:bigint,end:bigint,kind:string,value:string,before:string,after:string>>"
_NAMED = r"(?i)^(?:pass\w*|pwd|secret|token|api_?key) ?[=:]|^AKIA[0-9A-Z]{16}"


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often ``then`` reads it."""
    return F.transform(F.array(value), then)[0]


def places(text: Column, kind: str, pattern: str, check: bool) -> Column:
    """Spans of the leftmost matches, by code points, with what lies around them up to the next match;
    with ``check`` only the valid ones.

    The lengths of the matches and of the gaps between them add up to the places. Only what is kept
    is appended, so the many numbers of a table cost no more than reading them.
    """

    def paired(gaps: Column) -> Column:
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        return F.arrays_zip(hits.alias("hit"), F.slice(gaps, 1, F.size(gaps) - 1).alias("gap"), F.slice(gaps, 2, F.size(gaps)).alias("next"))

    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPANS).alias("found"))

    def add(got: Column, pair: Column) -> Column:
        start = got["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        one = F.struct(
            F.lit(KINDS.index(kind)).alias("rank"), start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), pair["hit"].alias("value"),
            F.substring(pair["gap"], -AROUND, AROUND).alias("before"), F.substring(pair["next"], 1, AROUND).alias("after"),
        )
        found = F.concat(got["found"], F.array(one))
        return F.struct(end.alias("at"), (F.when(_valid(kind, pair["hit"]), found).otherwise(got["found"]) if check else found).alias("found"))

    return F.aggregate(let(F.split(text, pattern, -1), paired), none, add, lambda got: got["found"])


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the check digit of a string of digits is right."""

    def worth(i: Column) -> Column:
        d = F.substring(number, F.length(number) - i + 1, F.lit(1)).try_cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 0, twice).otherwise(d)

    terms = F.transform(F.sequence(F.lit(1), F.greatest(F.length(number), F.lit(1))), worth)
    return F.coalesce(F.aggregate(terms, F.lit(0), lambda a, b: a + b) % 10 == 0, F.lit(False))


def octets(value: Column) -> Column:
    """Whether every dotted part is at most 255."""
    return F.forall(
        F.split(value, r"\."),
        lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)).between(0, 255),
    )


def _valid(kind: str, value: Column) -> Column:
    n = F.length(digits(value))
    if kind == "ip":
        return octets(value)
    if kind == "card":
        # the length first: the checksum runs over short numbers only
        return F.when(n.between(13, 19), luhn(digits(value))).otherwise(False)
    return n.between(9, 15) if kind == "phone" else F.lit(True)


def _searched(text: Column, patterns: dict[str, str], check: bool) -> Column:
    """Spans of all kinds with their rank and kind; an empty array where there can be none."""
    parts = [places(text, kind, pattern, check) for kind, pattern in patterns.items()]
    return F.when(text.rlike(r"[0-9@]|\(at\)|\[at\]"), F.concat(*parts)).otherwise(F.array().cast(_SPANS))


def base_spans(text: Column) -> Column:
    return _searched(text, BASE, True)


def candidates(text: Column) -> Column:
    return _searched(text, WIDE, False)


N_FEATURES = 27


def features(c: Column) -> list[Column]:
    """Numbers on the format and the context of a candidate."""
    value, number = c["value"], digits(c["value"])
    count = lambda keep: F.length(F.regexp_replace(value, f"[^{keep}]", ""))
    flags = [
        value.startswith("+"), value.contains("("), value.contains("@"), F.when(F.length(number).between(13, 19), luhn(number)).otherwise(False),
        octets(value), c["before"].rlike(r"\w$"), c["after"].rlike(r"^\w"), c["before"].rlike(r"[0-9]\s*$"), c["after"].rlike(r"^\s*[0-9]"),
        *(c["before"].rlike(h) for h in HINTS), value.rlike(HINTS[0]), value.rlike("[=:]"),
    ]
    numbers = [
        F.length(value), F.length(number), count("A-Z"), count("a-z"), count(r"\s.()-"),
        F.size(F.array_distinct(F.split(value, ""))), *((c["rank"] == i) for i in range(len(KINDS))),
    ]
    return [F.coalesce(x.cast("double"), F.lit(0.0)) for x in [*flags, *numbers]]


def overlaps(spans: Column, c: Column, same: bool = False) -> Column:
    return F.exists(spans, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"]) & ((s["rank"] == c["rank"]) | F.lit(not same)))


@dataclass(frozen=True)
class Model:
    """``trees``: nested ``(feature, threshold, left, right)`` or a leaf's value, with its weight."""

    trees: list[tuple[float, object]] = field(default_factory=list)
    thresholds: dict[str, float] = field(default_factory=dict)

    def score(self, columns: list[Column]) -> Column:
        """The chance that a candidate with these features is personal data."""
        def value(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, split, left, right = node
            return F.when(columns[feature] <= split, value(left)).otherwise(value(right))

        total = reduce(lambda a, b: a + b, (F.lit(w) * value(t) for w, t in self.trees))
        return 1 / (1 + F.exp(-2 * total))


def _nodes(node) -> object:
    """A tree of the fitted classifier as nested tuples."""
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _nodes(node.leftChild()), _nodes(node.rightChild())


def labelled(docs: DataFrame) -> DataFrame:
    """All candidates whose class the checks tell: kind, class, hash and features, without their values."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc", base_spans(F.col("text")).alias("base"), candidates(F.col("text")).alias("wide"))
    rows = rows.select("doc", "base", F.explode("wide").alias("c"))
    c = F.col("c")
    bare = ~c["value"].rlike(_NAMED) & ~overlaps(F.col("base"), c)
    wrong = F.when(c["kind"] == "ip", ~octets(c["value"])).when(c["kind"] == "card", ~_valid("card", c["value"])).when(
        c["kind"] == "secret", bare & ((F.length("c.value") < 16) | ~c["value"].rlike("[A-Za-z]"))  # numbers are no secrets, however long
    )
    label = F.when(overlaps(F.col("base"), c, True) | (c["kind"] == "secret") & c["value"].rlike(_NAMED), 1.0).when(wrong, 0.0)
    order = F.xxhash64("doc", "c.start", "c.rank", "c.value")
    told = rows.select("c", label.alias("label"), order.alias("hash")).where("label IS NOT NULL")
    return told.select(c["kind"].alias("kind"), "label", "hash", *(x.alias(f"f{i}") for i, x in enumerate(features(c))))


def sampled(rows: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` of the labelled rows with their fold, an equal part for each kind and class.

    Groups are salted, so a frequent kind is not ranked in one task, and each task sends at most
    ``SALTED`` rows of a group.
    """
    part = max(1, sample // (2 * len(KINDS)))
    salts = -(-part // SALTED)
    group = Window.partitionBy("kind", "label", F.pmod(F.xxhash64("hash"), F.lit(salts))).orderBy("hash")
    few = rows.withColumn("place", F.row_number().over(group)).where(F.col("place") <= part // salts).drop("place")
    place = F.row_number().over(Window.partitionBy("kind", "label").orderBy("hash"))
    return few.withColumn("apart", place % 4 == 1)


def bins(rows: DataFrame, seen: DataFrame, model: Model) -> DataFrame:
    """How many labelled rows outside ``seen`` have a score, in hundredths, by kind, and how many of them are right."""
    score = model.score([F.col(f"f{i}") for i in range(N_FEATURES)])
    scored = rows.join(F.broadcast(seen.select("hash")), "hash", "left_anti").select("kind", "label", F.floor(score * 100).alias("bin"))
    return scored.groupBy("kind", "bin").agg(F.count("*").alias("n"), F.sum("label").alias("good"))


def train(docs: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH, precision: float = PRECISION) -> Model:
    """Boosted trees on three of four sampled candidates, thresholds on all others.

    The texts are read once: the labelled candidates are written, and both steps read them.
    """
    every = written(labelled(docs), "labelled")
    seen = written(sampled(every, sample), "candidates").where("NOT apart")
    if seen.select("label").distinct().count() < 2:
        return Model()
    names = [n for n in seen.columns if n.startswith("f")]
    table = VectorAssembler(inputCols=names, outputCol="features").transform(seen)
    fitted = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, seed=7, checkpointInterval=-1).fit(table)
    parts = [(float(w), _nodes(t._java_obj.rootNode())) for w, t in zip(fitted.treeWeights, fitted.trees, strict=True)]
    thresholds: dict[str, float] = {}
    found = bins(every, seen, Model(parts)).collect()  # kinds x 101 rows
    for kind in KINDS:
        n = good = 0.0
        thresholds[kind] = math.inf
        for row in sorted((r for r in found if r.kind == kind), key=lambda r: -r.bin):
            n, good = n + row.n, good + row.good
            if good >= precision * n:
                thresholds[kind] = row.bin / 100
    return Model(parts, thresholds)


def added_spans(text: Column, base: Column, model: Model) -> Column:
    """The chosen candidates that overlap no base span."""
    used = [k for k in KINDS if model.thresholds.get(k, math.inf) < math.inf]
    if not used:
        return F.array().cast(_SPANS)

    def rated(s: Column) -> Column:
        limit = reduce(lambda a, k: F.when(s["c"]["kind"] == k, model.thresholds[k]).otherwise(a), used, F.lit(2.0))
        chance = model.score([s["f"][i] for i in range(N_FEATURES)])
        return F.struct(s["c"]["start"].alias("start"), (-chance).alias("worse"), limit.alias("limit"), s["c"].alias("c"))

    free = F.filter(candidates(text), lambda c: ~overlaps(base, c))
    scored = F.transform(F.transform(free, lambda c: F.struct(c.alias("c"), F.array(*features(c)).alias("f"))), rated)
    chosen = F.array_sort(F.filter(scored, lambda s: -s["worse"] >= s["limit"]))
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPANS).alias("found"))

    def keep(got: Column, s: Column) -> Column:
        more = F.struct(s["c"]["end"].alias("at"), F.concat(got["found"], F.array(s["c"])).alias("found"))
        return F.when(s["c"]["start"] < got["at"], got).otherwise(more)

    return F.aggregate(chosen, none, keep, lambda got: got["found"])


def spans(text: Column, model: Model) -> Column:
    """``struct<base, spans>``: the base spans, and all spans, each by kind and then by start."""
    return let(base_spans(text), lambda base: F.struct(
        F.array_sort(base).alias("base"), F.array_sort(F.concat(base, added_spans(text, base, model))).alias("spans")
    ))


def find(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, the number of base spans by kind, ``base`` and ``spans`` (all), in order."""
    text = F.coalesce("text", F.lit(""))
    count = lambda base, kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    found = let(spans(text, model), lambda s: F.struct(*(count(s["base"], k) for k in BASE), s["base"].alias("base"), s["spans"].alias("spans")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.inline(F.array(found)))


def listed(found: str) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digests(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; null texts stay null.

    Of overlapping base spans the first names the kind, and all that they cover goes.
    """
    text = F.col("text")
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def cut(got: Column, s: Column) -> Column:
        gap = F.substring(text, (got["at"] + 1).cast("int"), (s["start"] - got["at"]).cast("int"))
        parts = F.concat(got["parts"], F.array(gap, F.concat(F.lit("["), s["kind"], F.lit("]"))))
        return F.struct(
            F.greatest(got["at"], s["end"]).alias("at"), F.when(s["start"] < got["at"], got["parts"]).otherwise(parts).alias("parts")
        )

    def joined(got: Column) -> Column:
        rest = F.substring(text, (got["at"] + 1).cast("int"), F.greatest(F.length(text), F.lit(1)))
        return F.concat(F.array_join(got["parts"], ""), rest)

    def redacted(found: Column) -> Column:
        places = F.array_sort(F.transform(found["spans"], lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
        return F.when(F.size(places) > 0, F.aggregate(places, none, cut, joined)).otherwise(text)

    return docs.withColumn("text", F.when(text.isNotNull(), let(spans(text, model), redacted)))
