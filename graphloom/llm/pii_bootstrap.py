"""Personal data by patterns and bootstrapped contextual extraction.

Base kinds (e-mail, IP, card, phone) are found by their fixed patterns.  They
and a few unmistakable secrets are the seed entities.  A lexical pattern is the
label in front of a value ("token =", "phone:"), with and without the word
before it.  Patterns and values form a bipartite graph: a pattern is as good as
the share of its values that are known entities, a value is as good as its
patterns together, and both are scored in turns; values under a high-confidence
pattern are new identifiers.  Only DataFrame functions are used.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.scratch import materialize

ROUNDS = 3
MIN_SUPPORT = 3.0  # score mass of known values a pattern needs
MIN_PATTERN = 0.6  # confidence a pattern needs to pass on belief
MIN_REPORT = 0.8  # confidence a pattern needs to report a new identifier

# Fixed patterns of the base kinds, written so that they never backtrack over a
# long run: a match may only start where a leftmost search would start it.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Seeds beyond the base kinds: access keys and hexadecimal secrets.
SECRET = (
    r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|(?=[a-f]*+[0-9])(?=[0-9]*+[a-f])[0-9a-f]{16,64}+)(?![A-Za-z0-9])"
)
# A label, its mark and the value after it; the word before the label is looked up apart.
LABELLED = r"(?<![A-Za-z0-9_-])[A-Za-z_][A-Za-z0-9_-]{1,40}+\x20?[=:#]\x20?[^\x20\x09-\x0D]++"
LABEL = r"^([A-Za-z0-9_-]+\x20?[=:#]\x20?)"
KINDS = ("email", "ip", "card", "phone", "secret")

_SPAN = "array<struct<s:int,e:int,m:string>>"


def _ip_ok(m: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+(?=.)", "")
        return F.when(F.length(bare) <= 3, bare.cast("int") <= 255).otherwise(False)

    return F.forall(F.split(m, r"\."), small)


def _card_ok(m: Column) -> Column:
    digits = F.regexp_replace(m, r"[\x20-]", "")
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when((n - i) % 2 == 1, doubled).otherwise(d)

    luhn = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + value(i))
    return F.when(n.between(16, 19), luhn % 10 == 0).otherwise(False)


def _phone_ok(m: Column) -> Column:
    return F.length(F.regexp_replace(m, "[^0-9]", "")).between(8, 15)


_FINDERS: dict[str, tuple[str, Callable[[Column], Column], Callable[[Column], Column]]] = {
    "email": (EMAIL, lambda t: t.contains("@"), lambda m: F.lit(True)),
    "ip": (IP, lambda t: t.rlike(r"[0-9]\.[0-9]"), _ip_ok),
    "card": (CARD, lambda t: t.rlike(CARD), _card_ok),
    "phone": (PHONE, lambda t: t.rlike(r"\+[0-9]"), _phone_ok),
    "secret": (SECRET, lambda t: t.rlike(SECRET), lambda m: F.lit(True)),
    "labelled": (LABELLED, lambda t: t.rlike("[=:#]"), lambda m: F.lit(True)),
}


def _on_match(keep: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda x: keep(x["m"])


def _with_spans(df: DataFrame, text: str) -> DataFrame:
    """Add one array of spans (start, end in code points, match) per finder.

    The gaps that ``split`` leaves and the matches alternate, so their lengths
    give every match's place.
    """
    empty = F.array().cast("array<string>")
    for kind, (regex, guard, _) in _FINDERS.items():
        some = guard(F.col(text))
        df = df.withColumns({
            f"_m_{kind}": F.when(some, F.regexp_extract_all(F.col(text), F.lit(regex), F.lit(0))).otherwise(empty),
            f"_g_{kind}": F.when(some, F.split(F.col(text), regex, -1)).otherwise(empty),
        })
    cols = {}
    for kind, (_, _, keep) in _FINDERS.items():
        pairs = F.filter(
            F.zip_with(f"_m_{kind}", f"_g_{kind}", lambda m, g: F.struct(m.alias("m"), g.alias("g"))),
            lambda p: p["m"].isNotNull(),
        )

        def place(acc: Column, p: Column) -> Column:
            start = acc["at"] + F.length(p["g"])
            end = start + F.length(p["m"])
            span = F.struct(start.alias("s"), end.alias("e"), p["m"].alias("m"))
            return F.struct(end.alias("at"), F.array_append(acc["out"], span).alias("out"))

        found = F.aggregate(
            pairs, F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out")), place, lambda acc: acc["out"]
        )
        cols[kind] = F.when(F.size(f"_m_{kind}") > 0, F.filter(found, _on_match(keep))).otherwise(
            F.array().cast(_SPAN)
        )
    return df.withColumns(cols)


def _overlaps(spans: Column, s: Column, e: Column) -> Column:
    return F.exists(spans, lambda x: (x["s"] < e) & (x["e"] > s))


def scan(docs: DataFrame, row: str | None = None) -> DataFrame:
    """Per row: base spans by kind, seed secrets outside them, and labelled values."""
    named = docs.select(
        F.col(row).alias("row") if row else F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("_t"),
    )
    found = _with_spans(named, "_t")
    base = F.concat("email", "ip", "card", "phone")
    found = found.withColumn("_base", base)
    found = found.withColumn(
        "secret", F.filter("secret", lambda x: ~_overlaps(F.col("_base"), x["s"], x["e"]))
    )

    def mention(x: Column) -> Column:
        label = F.regexp_extract(x["m"], LABEL, 1)
        raw = F.substring(x["m"], F.length(label) + 1, F.lit(1 << 30))
        value = F.regexp_replace(raw, r"^[\"'(\[<]+|[\"')\]>.,;:!?]+$", "")
        lead = F.length(F.regexp_extract(raw, r"^([\"'(\[<]*)", 1))
        start = x["s"] + F.length(label) + lead
        before = F.regexp_extract(F.substring("_t", F.greatest(F.lit(1), x["s"] - 40), F.least(F.lit(41), x["s"])), r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*$", 1)
        return F.struct(
            start.alias("s"),
            (start + F.length(value)).alias("e"),
            value.alias("value"),
            F.lower(F.regexp_replace(label, r"\x20", "")).alias("label"),
            F.lower(before).alias("before"),
        )

    mentions = F.filter(F.transform("labelled", mention), lambda x: F.length(x["value"]) >= 4)
    return found.select("row", "doc_id", "email", "ip", "card", "phone", "secret", mentions.alias("mentions"))


def _score(mentions: DataFrame) -> DataFrame:
    """Confidence of every (pattern, kind) after ``ROUNDS`` rounds over the graph.

    A value's belief is 1 for a seed, else the noisy-or of its patterns; a
    pattern's confidence is the belief its distinct values carry over their
    number plus one.
    """
    edges = materialize(
        mentions.select(F.explode("patterns").alias("pattern"), "value", "seed")
        .groupBy("pattern", "value").agg(F.max("seed").alias("seed")), "pattern-values",
    )
    seeds = edges.where("seed is not null").groupBy("value", F.col("seed").alias("kind")).agg(F.lit(1.0).alias("belief"))
    totals = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    belief = seeds
    patterns = None
    for _ in range(ROUNDS):
        mass = (
            edges.select("pattern", "value").join(belief, "value").groupBy("pattern", "kind").agg(F.sum("belief").alias("mass"))
        )
        patterns = materialize(
            mass.join(totals, "pattern").withColumn("confidence", F.col("mass") / (F.col("n") + 1))
            .where((F.col("mass") >= MIN_SUPPORT) & (F.col("confidence") >= MIN_PATTERN))
            .select("pattern", "kind", "confidence"), "patterns",
        )
        passed = (
            edges.select("pattern", "value").join(patterns, "pattern").groupBy("value", "kind")
            .agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("belief"))
        )
        belief = passed.unionByName(seeds).groupBy("value", "kind").agg(F.max("belief").alias("belief"))
    return patterns


def extract(docs: DataFrame, row: str | None = None) -> DataFrame:
    """Personal data of every row (``doc_id``, ``text``): ``row``, ``doc_id`` and
    the arrays ``email``, ``ip``, ``card``, ``phone`` (base spans: s, e, m),
    ``secret`` (seed secrets) and ``found`` (kind, s, e: new identifiers).

    Places are code points, end exclusive.  Null and empty texts have no spans,
    rows are independent of their ids, repeated rows are reported alike, other
    columns are ignored and an empty frame gives an empty frame.  New spans
    never overlap base spans or seeds.  ``row`` may name a unique column to use.
    """
    found = materialize(scan(docs, row), "pii-scan")
    each = found.select("row", F.explode("mentions").alias("x"), *KINDS)
    seed = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        seed = F.when(_overlaps(F.col(kind), F.col("x.s"), F.col("x.e")), F.lit(kind)).otherwise(seed)
    patterns = F.array(F.col("x.label"), F.concat_ws(" ", "x.before", "x.label"))
    mentions = each.select(
        "row", F.col("x.s").alias("s"), F.col("x.e").alias("e"), F.col("x.value").alias("value"),
        seed.alias("seed"), F.array_distinct(patterns).alias("patterns"),
    )
    mentions = materialize(mentions, "pii-mentions")
    good = _score(mentions).where(F.col("confidence") >= MIN_REPORT)
    new = (
        mentions.where("seed is null").select("row", "s", "e", F.explode("patterns").alias("pattern")).join(good, "pattern")
        .groupBy("row", "s", "e").agg(F.max(F.struct("confidence", "kind"))["kind"].alias("kind"))
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("kind", "s", "e"))).alias("found"))
    )
    return found.drop("mentions").join(new, "row", "left").withColumn(
        "found", F.coalesce("found", F.array().cast("array<struct<kind:string,s:int,e:int>>"))
    )


def span_text(spans: Column) -> Column:
    """kind:start:end of (kind number, start, end) spans by kind, then start, comma-joined."""
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            F.sort_array(spans),
            lambda x: F.concat_ws(":", F.get(kind, x["k"]), x["s"].cast("string"), x["e"].cast("string")),
        ),
        ",",
    )


def numbered_spans(kinds: tuple[str, ...]) -> Column:
    """The spans of the given kinds as (kind number, start, end)."""

    def of(kind: str) -> Column:
        number = F.lit(KINDS.index(kind))
        return F.transform(kind, lambda x: F.struct(number.alias("k"), x["s"].alias("s"), x["e"].alias("e")))

    return F.concat(*map(of, kinds))


def found_spans() -> Column:
    """The new identifiers as (kind number, start, end)."""
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.transform(
        "found",
        lambda x: F.struct((F.array_position(kind, x["kind"]) - 1).cast("int").alias("k"), x["s"].alias("s"), x["e"].alias("e")),
    )


def redact(docs: DataFrame, mask: str = "[PII]") -> DataFrame:
    """``docs`` with every span (base, seed, found) of ``text`` replaced by ``mask``.

    Overlapping spans are masked once.  Null and empty texts stay as they are.
    """
    base = materialize(docs.withColumn("_llm_row", F.monotonically_increasing_id()), "pii-input")
    spans = extract_by_row(base)
    merged = F.aggregate(
        F.sort_array("_llm_spans"),
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, x: F.when(
            x["s"] >= acc["at"],
            F.struct(
                x["e"].alias("at"),
                F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, x["s"] - acc["at"]), F.lit(mask)).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(acc["at"], x["e"]).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.lit(1 << 30))),
    )
    text = F.when(F.size("_llm_spans") > 0, merged).otherwise(F.col("text"))
    return base.join(spans, "_llm_row", "left").withColumn("text", text).drop("_llm_row", "_llm_spans")


def extract_by_row(base: DataFrame) -> DataFrame:
    """(``_llm_row``, ``_llm_spans``: start, end) of rows that have spans."""
    all_spans = F.concat(numbered_spans(KINDS), found_spans())
    found = extract(base.select("_llm_row", "doc_id", "text"), row="_llm_row")
    plain = F.transform(all_spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    return found.select(F.col("row").alias("_llm_row"), plain.alias("_llm_spans")).where(F.size("_llm_spans") > 0)
