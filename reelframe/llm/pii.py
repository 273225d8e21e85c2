"""Personal data by candidate spans and boosted trees, in DataFrame functions only.

Generators propose spans: four strict kinds, whose matches are always kept if they pass their
check, and wide kinds that take anything of a likely shape. Boosted trees score the wide ones
by format and context, and a threshold for each kind, set on rows that the trees have not
seen, decides. Everything happens within a row: no shuffle, whatever the number of spans.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelframe.llm.workers import stored

# Possessive groups and look-behinds keep the definition's leftmost matches, but never read a
# run of characters twice, so that a long run costs linear time. ``\G`` is the end of the last match.
# Possessive repeats are also the ones that run as a loop; others call themselves once a round, and
# a few thousand rounds are more than a thread's stack holds.
LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A cheap test that a text must pass before a pattern is tried.
HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){13}", "phone": r"\+[0-9]"}

WIDE = {
    "secret": r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+",
    "number": r"(?<![0-9A-Za-z+.])[(]?[0-9](?:[ ().-]{0,2}[0-9]){6,}+",
    "handle": r"(?i)(?:(?<![a-z0-9._%+-])|\G)[a-z0-9._%+-]++ ?[\[(]at[\])] ?[a-z0-9-]++(?: ?(?:\.|[\[(]dot[\])]) ?[a-z0-9-]++)++",
}
#: What a wide match must not be followed by, where the pattern itself cannot say so in linear time.
NOT_AFTER = {"number": "^[0-9A-Za-z]"}
KINDS = [*BASE, *WIDE]
CONTEXT = 32
MATCH = "struct<start:int,end:int,found:string,before:string>"
SPAN = "struct<start:int,rank:int,end:int>"
SECRET_WORDS = r"(?i)(?:token|secret|password|passwd|pwd|key|auth|bearer)[^A-Za-z0-9]*$"
CONTACT_WORDS = r"(?i)(?:tel|phone|call|fax|mobile|mail|contact|card|account|iban|ssn)[^A-Za-z0-9]*$"

TREES, DEPTH = 12, 3
#: Share of right ones among the held-out candidates above a threshold.
PRECISION = 0.95
SURE = 0.5


#: Appending to an array copies it, and so does taking a slice. So an array is folded in pieces, cut
#: from blocks: n items cost n times these, not n times n.
PIECE, BLOCK = 64, 4096
#: Characters in a block of a text that is redacted.
TEXT_BLOCK = 1024


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def folded(items: Column, at: int, out: str, add: Callable[[Column, Column], Column]) -> Column:
    """Array of pieces (at, out), which ``add`` makes of one item after the other: it takes a state
    (at, out) with ``out`` an array of this type, and an item, and returns the next state."""
    nothing = F.expr(f"cast(array() as array<struct<at:int,out:array<{out}>>>)")
    empty = F.expr(f"cast(array() as array<{out}>)")

    def cut(whole: Column, size: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(whole), F.lit(size)), lambda k: F.slice(whole, k, F.lit(size)))

    def onward(pieces: Column, piece: Column) -> Column:
        begun = F.coalesce(F.try_element_at(pieces, F.lit(-1))["at"], F.lit(at))
        return F.concat(pieces, F.array(F.aggregate(piece, named(at=begun, out=empty), add)))

    def of(whole: Column) -> Column:
        pieces = F.flatten(F.transform(cut(whole, BLOCK), lambda block: cut(block, PIECE)))
        return F.when(F.size(whole) > 0, F.aggregate(pieces, nothing, onward)).otherwise(nothing)

    return bound(items, of)


def joined(pieces: Column) -> Column:
    return F.flatten(F.transform(pieces, lambda piece: piece["out"]))


def matches(text: Column, pattern: str, hint: str, not_after: str | None = None) -> Column:
    """All matches with their places: array of (start, end, found, before), in code points."""
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    after = F.slice(gaps, F.lit(2), F.size(gaps))
    paired = F.arrays_zip(gaps.alias("gap"), found.alias("found"), after.alias("after"))

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["found"])
        one = named(start=start, end=end, found=pair["found"], before=F.right(pair["gap"], F.lit(CONTEXT)))
        kept = F.array(one)
        if not_after:
            kept = F.when(~pair["after"].rlike(not_after), kept).otherwise(F.slice(kept, 1, 0))
        return named(at=end, out=F.concat(state["out"], kept))

    none = F.expr(f"cast(array() as array<{MATCH}>)")
    pairs = F.slice(paired, F.lit(1), F.size(found))
    return F.when(text.rlike(hint), joined(folded(pairs, 0, MATCH, add))).otherwise(none)


def named(**columns: Column) -> Column:
    return F.named_struct(*(x for name, column in columns.items() for x in (F.lit(name), column)))


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(found: Column) -> Column:
    number = digits(found)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(number, F.length(number) - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, digit).otherwise(digit * 2 - F.when(digit > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def octets(found: Column) -> Column:
    plain = F.transform(F.split(found, r"\."), lambda part: F.ltrim(part, F.lit("0")))
    return F.forall(plain, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))


CHECKS = {
    "email": None,
    "ip": octets,
    "card": luhn,
    "phone": lambda found: F.length(digits(found)).between(10, 15),
}


def base_spans(text: Column) -> Column:
    """The strict kinds: array of (start, rank, end), sorted."""

    def of(rank: int, kind: str) -> Column:
        spans, check = matches(text, BASE[kind], HINT[kind]), CHECKS[kind]
        if check is not None:
            spans = F.filter(spans, lambda s: check(s["found"]))
        return F.transform(spans, lambda s: named(start=s["start"], rank=F.lit(rank), end=s["end"]))

    return F.array_sort(F.concat(*(of(rank, kind) for rank, kind in enumerate(BASE))))


def share(found: Column, unwanted: str) -> Column:
    return F.length(F.regexp_replace(found, unwanted, "")) / F.length(found)


def features(rank: int, c: Column) -> Column:
    found, before = c["found"], c["before"]
    flags = [
        before.rlike(SECRET_WORDS),
        before.rlike(CONTACT_WORDS),
        before.rlike("[\"'`]$"),
        before.rlike("[=:] ?[\"'`]?$"),
        before.rlike("[A-Za-z] $"),
        found.rlike("^[0-9a-f]+$"),
    ]
    measures = [
        F.lit(rank),
        F.length(found),
        share(found, "[^0-9]"),
        share(found, "[^A-Za-z]"),
        share(found, "[^A-Z]"),
        F.size(F.array_distinct(F.split(found, ""))) / F.length(found),
        F.length(digits(found)),
    ]
    return F.array(*(m.cast("double") for m in [*measures, *flags]))


def candidates(text: Column) -> Column:
    """The wide kinds: array of (start, rank, end, found, before, f)."""

    def of(rank: int, pattern: str) -> Column:
        return F.transform(
            matches(text, pattern, pattern, NOT_AFTER.get(KINDS[rank])),
            lambda c: named(start=c["start"], rank=F.lit(rank), end=c["end"], found=c["found"], before=c["before"], f=features(rank, c)),
        )

    return F.concat(*(of(rank, pattern) for rank, pattern in enumerate(WIDE.values(), start=len(BASE))))


def likely(c: Column, base: Column) -> Column:
    """The rule that labels a candidate for training: a secret that is assigned to a name that
    says so, a number that holds a strict span, a written-out address."""
    holds = F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    assigned = c["before"].rlike("(?i)(?:token|secret|password|passwd|pwd|key)[\"' ]*[:=] *[\"'`]?$")
    secret, number = len(BASE), len(BASE) + 1
    return (
        F.when(c["rank"] == secret, assigned & c["found"].rlike("[0-9]"))
        .when(c["rank"] == number, holds | c["before"].rlike(CONTACT_WORDS))
        .otherwise(c["found"].rlike(r"(?i)dot|\."))
    )


def tree_score(description: str, f: Column) -> Column:
    """One regression tree, given by its printed form, as a CASE over the features."""
    lines = iter([line.strip() for line in description.splitlines() if re.match(r"\s*(If|Else|Predict)", line)])

    def node() -> Column:
        line = next(lines)
        if line.startswith("Predict"):
            return F.lit(float(line.split(":")[1]))
        feature, bound = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        below = node()
        next(lines)
        return F.when(f[int(feature)] <= float(bound), below).otherwise(node())

    return node()


class Scorer:
    """Boosted trees as a column, and the score from which each wide kind is taken."""

    def __init__(self, trees: list[tuple[float, str]], thresholds: dict[int, float]):
        self.trees, self.thresholds = trees, thresholds

    def score(self, f: Column) -> Column:
        margin = sum((weight * tree_score(tree, f) for weight, tree in self.trees), F.lit(0.0))
        return 1 / (1 + F.exp(-2 * margin))

    def takes(self, c: Column) -> Column:
        if not self.thresholds:
            return F.lit(False)
        bound = F.lit(2.0)
        for rank, threshold in self.thresholds.items():
            bound = F.when(c["rank"] == rank, threshold).otherwise(bound)
        return self.score(c["f"]) >= bound


def fit(docs: DataFrame, sample_documents: int | None = None) -> Scorer:
    """Trees fitted on the candidates of every distinct text; copies of a text, however many, are
    one. Given ``sample_documents``, only about that many texts, chosen by a hash of theirs, are
    taken; no query does so.

    With candidates of one class only, or none, there is nothing to learn and no wide span is
    taken. Two thirds of the texts fit the trees; the rest set the thresholds.
    """
    sample = docs.select("text").where(F.col("text").isNotNull())
    if sample_documents is not None:
        rows = docs.count()
        part = F.pmod(F.xxhash64("text"), F.lit(1_000_000))
        sample = sample.where(part < int(1_000_000 * min(1.0, sample_documents / max(rows, 1))))
    sample = sample.distinct()
    held = F.pmod(F.hash("text"), F.lit(3)) == 0
    found = sample.select(held.alias("held"), base_spans(F.col("text")).alias("base"), F.explode(candidates(F.col("text"))).alias("c"))
    found = found.select("held", F.col("c.rank").alias("rank"), F.col("c.f").alias("f"), likely(F.col("c"), F.col("base")).cast("double").alias("label"))
    found = stored(found, "pii-candidates")
    seen = {(r.held, r.label) for r in found.groupBy("held", "label").count().collect()}
    if not {(False, 0.0), (False, 1.0)} <= seen:
        return Scorer([], {})
    training = found.where(~F.col("held")).select(array_to_vector("f").alias("features"), "label")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7).fit(training)
    trees = [(w, t.toDebugString) for w, t in zip(model.treeWeights, model.trees, strict=True)]
    scorer = Scorer(trees, {})
    scored = found.where("held").groupBy("rank", F.round(scorer.score(F.col("f")), 2).alias("score"))
    counts = scored.agg(F.sum("label").alias("right"), F.count("*").alias("all")).collect()
    for rank in range(len(BASE), len(KINDS)):
        right = every = 0.0
        for row in sorted((r for r in counts if r["rank"] == rank), key=lambda r: -r["score"]):
            right, every = right + row["right"], every + row["all"]
            if row["score"] >= SURE and right >= PRECISION * every:
                scorer.thresholds[rank] = row["score"] - 0.005
    return scorer


def base_and_all(docs: DataFrame, scorer: Scorer, base: str, every: str) -> DataFrame:
    """The documents with two more columns: their base spans and all spans."""
    text, wide = F.coalesce(F.col("text"), F.lit("")), unused(docs, every + "_wide")
    found = docs.withColumns({base: base_spans(text), wide: candidates(text)})
    taken = F.transform(F.filter(wide, scorer.takes), lambda c: named(start=c["start"], rank=c["rank"], end=c["end"]))

    def before_base(state: Column, s: Column) -> Column:
        """From the end of the text: a wide span that reaches into the next base span goes."""
        strict = s["rank"] < len(BASE)
        kept = F.when(strict | (s["end"] <= state["at"]), F.concat(state["out"], F.array(s))).otherwise(state["out"])
        return named(at=F.when(strict, s["start"]).otherwise(state["at"]), out=kept)

    def after_others(state: Column, s: Column) -> Column:
        """From its start: so does one that begins inside a span before it."""
        kept = (s["rank"] < len(BASE)) | (s["start"] >= state["at"])
        return named(
            at=F.when(kept, F.greatest(state["at"], s["end"])).otherwise(state["at"]),
            out=F.when(kept, F.concat(state["out"], F.array(s))).otherwise(state["out"]),
        )

    free = joined(folded(F.reverse(F.array_sort(F.concat(base, taken))), 2**31 - 1, SPAN, before_base))
    spans = joined(folded(F.reverse(free), 0, SPAN, after_others))
    return found.withColumn(every, F.when(F.size(wide) == 0, F.col(base)).otherwise(spans)).drop(wide)


def unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def find(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, text, base, spans): sorted arrays of (start, rank, end), ``rank`` an index of KINDS.

    Base spans are all in ``spans``. A wide span that overlaps one before it, or a base span,
    gives way. A null or empty text has no spans; a null doc_id stays null; repeated rows give
    repeated rows; other columns are ignored, whatever their names. A text of any length is taken as
    a whole; time is in proportion to its length, and a little more to the number of its spans.
    """
    return base_and_all(docs.select("doc_id", "text"), scorer, "base", "spans")


def redact(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """The documents, all columns, with each span of their texts replaced by its kind, and
    ``n_chars``, if there is one, counted anew. A null text stays null."""
    base, every = unused(docs, "base"), unused(docs, "spans")
    found = base_and_all(docs, scorer, base, every).withColumn("text", redacted(F.col("text"), F.col(every)))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return found.select(docs.columns)


def span_names(spans: Column) -> Column:
    """kind:start:end by start, then kind, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", names[s["rank"]], s["start"].cast("string"), s["end"].cast("string"))))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become one.

    What stands between spans is taken from blocks of the text: to find a place in the whole of a
    text its characters are counted from the start, once for every span.
    """
    names = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))

    def of(blocks: Column) -> Column:
        def between(start: Column, end: Column) -> Column:
            first, last = F.floor(start / TEXT_BLOCK).cast("int"), F.floor(end / TEXT_BLOCK).cast("int")
            near = F.coalesce(F.get(blocks, first), F.lit(""))
            held = F.when(first == last, near).otherwise(F.concat_ws("", F.slice(blocks, first + 1, last - first + 1)))
            return F.substring(held, start - first * TEXT_BLOCK + 1, end - start)

        def add(state: Column, s: Column) -> Column:
            return F.when(
                s["start"] >= state["at"],
                named(at=s["end"], out=F.concat(state["out"], F.array(between(state["at"], s["start"]), names[s["rank"]]))),
            ).otherwise(named(at=F.greatest(state["at"], s["end"]), out=state["out"]))

        def whole(pieces: Column) -> Column:
            rest = between(F.try_element_at(pieces, F.lit(-1))["at"], F.length(text))
            return F.concat(F.concat_ws("", joined(pieces)), rest)

        return bound(folded(spans, 0, "string", add), whole)

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0))
    return F.when(F.size(spans) == 0, text).otherwise(bound(blocks, of))
