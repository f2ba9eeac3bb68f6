"""Personal data by patterns and bootstrapped contexts, in built-in functions.

Base kinds (``KINDS``) are found by regular expressions with checks (parts of
an address at most 255, Luhn digits, digit counts).  The method then learns
where such identifiers stand and adds what it finds there:

1. Every base span is an occurrence of an instance (its text), and so is
   every other word with a digit or ``@``, run of digit groups (``(017)
   555-7713``) and address in words (``ann at host dot org``); the two words
   before it, and the words on both sides, are its lexical patterns.  A word
   inside a run or address stands for itself only if it has a shape of step 3.
2. Instances seen as a base span are seeds of its kind.  On the graph of
   patterns and instances a pattern's confidence for a kind is the mean
   confidence of its instances, an instance's the noisy-or of its accepted
   patterns; a pattern is accepted with ``MIN_SUPPORT`` instances of the kind
   and a confidence of ``MIN_CONFIDENCE``.  ``ROUNDS`` rounds, so contexts
   learnt in one find the seeds of the next.
   A pattern's words are read from the ``CONTEXT`` characters on either side;
   the part inside them stands for a word that reaches further, the same in
   every text.
3. Occurrences in accepted patterns whose text has the least shape of the
   kind (``SHAPES``) become spans beside the base ones.

The graph is one row per distinct (pattern, instance) of the corpus; its
rounds are partial aggregates and equi-joins over written tables, so a
frequent context is summed where it lies and split where it is joined.

The expressions are written so that a match takes time in proportion to its
text: quantifiers are possessive and a match may only start where the run of
its characters starts, which finds the same spans.

Defined cases: a null text is empty and has no spans; repeated rows are all
returned with the same spans; rows without ``doc_id`` are kept apart by their
text; of equal positions the kind listed first comes first.  Other columns
are not read.  Positions are code points, the end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelscope.llm.staging import Staging

# The base patterns, each equal in what it finds to the plain form beside it.
KINDS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ORDER = list(KINDS)
# The least a discovered identifier must look like.
SHAPES = {
    "email": r"@|[\x20(\[]at[\x20)\]]",
    "ip": r"[0-9a-fA-F]+[.:][0-9a-fA-F]+[.:]",
    "card": r"(?:[0-9][^0-9]?){12}",
    "phone": r"(?:[0-9][^0-9]?){7}",
}
MIN_SUPPORT = 4
MIN_CONFIDENCE = 0.8
ROUNDS = 3
CONTEXT = 64

_SPACE = r"\x20\x09-\x0D"
_CANDIDATE = rf"(?<![^{_SPACE}])[^{_SPACE}0-9@]*+[0-9@][^{_SPACE}]*+"
# Digit groups joined by spaces, brackets, dots or hyphens: phones and cards without their checks.
_RUN = r"(?<![\p{L}\p{N}+(.-])\+?\(?[0-9]++(?:[\x20().-]{1,3}+[0-9]++(?![\p{L}\p{N}]))++"
_AT = r"(?:\x20at\x20|\x20?[(\[]at[)\]]\x20?)"
_DOT = r"(?:\x20dot\x20|\x20?[(\[]dot[)\]]\x20?|\.)"
_ADDRESS = rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++"
_CANDIDATES = {"word": _CANDIDATE, "run": _RUN, "address": _ADDRESS}
_SPAN = "array<struct<start:int,end:int,value:string,left:string,right:string>>"


def _matched(rows: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """``rows`` with the matches of each pattern in ``text`` and the gaps around them.

    They are columns of their own, read more than once below, so that no
    pattern is evaluated inside an array expression.
    """
    columns = []
    for name, pattern in patterns.items():
        columns.append(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias(f"{name}_values"))
        columns.append(F.split("text", pattern, -1).alias(f"{name}_gaps"))
    return rows.select("*", *columns)


def _found(name: str) -> Column:
    """Matches with their positions and neighbouring text.

    Gaps and matches alternate, so positions are running sums of lengths;
    they are summed in blocks of about the square root of the number of
    matches, since appending to an array copies it.
    """
    values, gaps = F.col(f"{name}_values"), F.col(f"{name}_gaps")
    count = F.least(F.size(values), F.size(gaps) - 1)

    def at(array: Column, i: Column) -> Column:
        return F.coalesce(F.get(array, i), F.lit(""))

    def step(i: Column) -> Column:
        left = F.concat(at(values, i - 2), at(gaps, i - 1), at(values, i - 1), at(gaps, i))
        right = F.concat(at(gaps, i + 1), at(values, i + 1), at(gaps, i + 2))
        return F.struct(
            F.length(at(gaps, i)).alias("gap"),
            F.length(at(values, i)).alias("size"),
            at(values, i).alias("value"),
            F.right(left, F.lit(CONTEXT)).alias("left"),
            F.left(right, F.lit(CONTEXT)).alias("right"),
        )

    def place(acc: Column, s: Column) -> Column:
        start = acc["at"] + s["gap"]
        end = start + s["size"]
        span = F.struct(start.alias("start"), end.alias("end"), s["value"].alias("value"), s["left"].alias("left"), s["right"].alias("right"))
        return F.struct(end.alias("at"), F.array_append(acc["spans"], span).alias("spans"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))
    width = F.ceil(F.sqrt(count)).cast("int")

    def block(b: Column) -> Column:
        inside = F.sequence(b * width, F.least((b + 1) * width, count) - 1)
        return F.aggregate(F.transform(inside, step), empty, place)

    blocks = F.transform(F.sequence(F.lit(0), F.ceil(count / width).cast("int") - 1), block)

    def shift(acc: Column, part: Column) -> Column:
        def moved(s: Column) -> Column:
            return F.struct(
                (s["start"] + acc["at"]).alias("start"),
                (s["end"] + acc["at"]).alias("end"),
                s["value"].alias("value"),
                s["left"].alias("left"),
                s["right"].alias("right"),
            )

        return F.struct(
            (acc["at"] + part["at"]).alias("at"),
            F.array_append(acc["parts"], F.transform(part["spans"], moved)).alias("parts"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("parts"))
    return F.when(count > 0, F.flatten(F.aggregate(blocks, start, shift)["parts"])).otherwise(F.array().cast(_SPAN))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        # up to 255 with any number of leading zeros
        return F.forall(
            F.split(value, r"\."),
            lambda p: (F.length(F.regexp_replace(p, "^0++", "")) <= 3)
            & (F.coalesce(F.regexp_replace(p, "^0++", "").try_cast("int"), F.lit(0)) <= 255),
        )
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _kind_spans(kind: str) -> Column:
    valid = F.filter(_found(kind), lambda s: _valid(kind, s["value"]))
    rank = F.lit(ORDER.index(kind))
    return F.transform(
        valid,
        lambda s: F.struct(
            s["start"].alias("start"),
            rank.alias("rank"),
            s["end"].alias("end"),
            s["value"].alias("value"),
            s["left"].alias("left"),
            s["right"].alias("right"),
        ),
    )


def _with_spans(rows: DataFrame, *others: str) -> DataFrame:
    """``rows`` with ``spans``, all base spans by start, then kind; matches of ``others`` are kept too."""
    matched = _matched(rows, KINDS | {name: _CANDIDATES[name] for name in others})
    kept = [*rows.columns, *(f"{name}_{part}" for name in others for part in ("values", "gaps"))]
    return matched.select(*kept, F.array_sort(F.concat(*(_kind_spans(kind) for kind in ORDER))).alias("spans"))


def _slim(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))


def _count(spans: str, kind: str) -> Column:
    rank = ORDER.index(kind)
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("bigint").alias(f"n_{kind}")


def _masked(word: Column) -> Column:
    return F.translate(F.lower(word), "123456789", "000000000")


def _blocks(spans: str) -> Column:
    """Spans sorted by start, in blocks of about the square root of their number with the range of each.

    A column of its own, as every candidate of the text is held against it.
    """
    count = F.size(spans)
    width = F.ceil(F.sqrt(count)).cast("int")

    def block(b: Column) -> Column:
        inside = F.slice(spans, b * width + 1, width)
        return F.struct(
            F.get(inside, F.lit(0))["start"].alias("start"),
            F.array_max(F.transform(inside, lambda s: s["end"])).alias("end"),
            F.transform(inside, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("spans"),
        )

    none = F.array().cast("array<struct<start:int,end:int,spans:array<struct<start:int,end:int>>>>")
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(count / width).cast("int") - 1), block)
    return F.when(count > 0, blocks).otherwise(none)


def _apart(c: Column, blocks: Column) -> Column:
    def meets(s: Column) -> Column:
        return (s["start"] < c["end"]) & (c["start"] < s["end"])

    return ~F.exists(blocks, lambda b: meets(b) & F.exists(b["spans"], meets))


def _within(c: Column, blocks: Column) -> Column:
    """Whether a span of ``blocks`` has the place of ``c``."""

    def same(s: Column) -> Column:
        return (s["start"] == c["start"]) & (s["end"] == c["end"])

    return F.exists(blocks, lambda b: (b["start"] <= c["start"]) & (c["end"] <= b["end"]) & F.exists(b["spans"], same))


def _wide() -> Column:
    """Runs and addresses apart from the base spans, by start."""

    def whole(s: Column) -> Column:
        rank = F.lit(-1).alias("rank")
        return F.struct(s["start"].alias("start"), rank, *(s[k].alias(k) for k in ("end", "value", "left", "right")))

    every = F.transform(F.concat(_found("run"), _found("address")), whole)
    return F.array_sort(F.filter(every, lambda c: _apart(c, F.col("span_blocks"))))


def _occurrences() -> Column:
    """Base spans and the other candidates, with the words around them."""
    spans, wide, wide_blocks = F.col("spans"), F.col("wide"), F.col("wide_blocks")

    def core(s: Column) -> Column:
        lead = F.length(F.regexp_extract(s["value"], r"^[^\p{L}\p{N}+]++", 0))
        rest = F.substring(s["value"], lead + 1, F.length(s["value"]))
        value = F.regexp_replace(rest, r"(?<=[\p{L}\p{N}])[^\p{L}\p{N}]++$", "")
        start = s["start"] + lead
        return F.struct(
            start.alias("start"),
            F.lit(-1).alias("rank"),
            (start + F.length(value)).alias("end"),
            value.alias("value"),
            s["left"].alias("left"),
            s["right"].alias("right"),
        )

    word = F.filter(F.transform(_found("word"), core), lambda c: (c["end"] > c["start"]) & _apart(c, F.col("span_blocks")))
    any_shape = "|".join(SHAPES.values())
    # of the words in a wide candidate those of a shape, unless they are all of it
    free = F.concat(
        wide,
        F.filter(
            word,
            lambda c: _apart(c, wide_blocks) | (c["value"].rlike(any_shape) & ~_within(c, wide_blocks)),
        ),
    )

    def placed(s: Column) -> Column:
        two = rf"(?:^|[{_SPACE}])([^{_SPACE}]+[{_SPACE}]+[^{_SPACE}]+)[{_SPACE}]*$"
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["rank"].alias("rank"),
            F.lower(s["value"]).alias("instance"),
            _masked(F.regexp_extract(s["left"], two, 1)).alias("two"),
            _masked(F.regexp_extract(s["left"], rf"([^{_SPACE}]+)[{_SPACE}]*$", 1)).alias("before"),
            _masked(F.regexp_extract(s["right"], rf"^[{_SPACE}]*([^{_SPACE}]+)", 1)).alias("after"),
        )

    return F.transform(F.concat(spans, free), placed)


def _patterns() -> Column:
    both = (F.col("o.before") != "") & (F.col("o.after") != "")
    return F.filter(
        F.array(
            F.when(F.col("o.two") != "", F.concat(F.lit("before "), F.regexp_replace("o.two", rf"[{_SPACE}]+", " "))),
            F.when(both, F.concat_ws(" ", F.lit("around"), "o.before", F.lit("_"), "o.after")),
        ),
        lambda p: p.isNotNull(),
    )


def _discovered(rows: DataFrame, stage: Staging) -> DataFrame:
    """``doc_id, text_hash, start, end, rank`` of spans that accepted patterns add."""
    seen = stage.write(
        rows.select("doc_id", "text_hash", F.explode("occurrences").alias("o")).select(
            "doc_id", "text_hash", "o.start", "o.end", "o.rank", "o.instance", F.explode(_patterns()).alias("pattern")
        ),
        "occurrences",
    )
    graph = stage.write(seen.select("pattern", "instance").distinct(), "graph")
    sizes = stage.write(graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("instances")), "sizes")
    seeds = seen.where("rank >= 0").select("instance", "rank").distinct().withColumn("confidence", F.lit(1.0))
    seeds = stage.write(seeds, "seeds")
    known = seeds
    accepted = None
    for turn in range(ROUNDS):
        scored = (
            graph.join(known, "instance")
            .groupBy("pattern", "rank")
            .agg(F.sum("confidence").alias("mass"), F.count(F.lit(1)).alias("support"))
            .where(F.col("support") >= MIN_SUPPORT)
            .join(sizes, "pattern")
            .select("pattern", "rank", (F.col("mass") / F.col("instances")).alias("score"))
            .where(F.col("score") >= MIN_CONFIDENCE)
        )
        accepted = stage.write(scored, f"accepted{turn}")
        if accepted.isEmpty():
            break
        found = (
            graph.join(accepted, "pattern")
            .groupBy("instance", "rank")
            .agg((1 - F.product(1 - F.col("score"))).alias("confidence"))
            .where(F.col("confidence") >= MIN_CONFIDENCE)
        )
        known = stage.write(
            found.unionByName(seeds).groupBy("instance", "rank").agg(F.max("confidence").alias("confidence")), f"known{turn}"
        )
    shaped = F.lit(False)
    for rank, kind in enumerate(ORDER):
        shaped = shaped | ((F.col("rank") == rank) & F.col("instance").rlike(SHAPES[kind]))
    best = F.max(F.struct("score", (-F.col("rank")).alias("behind")))
    return (
        seen.where("rank < 0")
        .drop("rank")
        .join(accepted, "pattern")
        .where(shaped)
        .groupBy("doc_id", "text_hash", "start", "end")
        .agg(best.alias("best"))
        .select("doc_id", "text_hash", "start", "end", (-F.col("best.behind")).alias("rank"))
    )


def _text(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))


def _bases(docs: DataFrame, stage: Staging) -> DataFrame:
    """Each row's base spans and occurrences, without its text."""
    rows = (
        _with_spans(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), *_CANDIDATES)
        .withColumn("span_blocks", _blocks("spans"))
        .withColumn("wide", _wide())
        .withColumn("wide_blocks", _blocks("wide"))
    )
    return stage.write(
        rows.select("doc_id", "text_hash", _slim(F.col("spans")).alias("base"), _occurrences().alias("occurrences")), "base"
    )


def _added(bases: DataFrame, stage: Staging) -> DataFrame:
    """The discovered spans of each text, in one array."""
    span = F.struct("start", "rank", "end")
    found = _discovered(bases, stage).groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(span)).alias("added"))
    return stage.write(found, "added")


def _told(spans: Column) -> Column:
    name = F.array(*(F.lit(k) for k in ORDER))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(name, s["rank"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every row of ``docs`` (``doc_id``, ``text``).

    Counts and digest are of the base spans; ``spans`` lists them and the discovered ones.
    """
    stage = Staging(docs.sparkSession, "pii")
    bases = _bases(_text(docs), stage)
    added = _added(bases, stage).withColumnsRenamed({"doc_id": "own_id", "text_hash": "own_hash"})
    rows = bases.drop("occurrences").join(
        added, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")), "left"
    )
    every = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))
    return rows.select(
        "doc_id",
        *(_count("base", kind) for kind in ORDER),
        F.sha2(_told(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _told(every).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, as in ``[EMAIL]``.

    All columns stay; ``n_chars``, where there is one, counts the new text.
    Overlapping spans are replaced as one, under the name of the first.  A
    null text stays null.
    """
    stage = Staging(docs.sparkSession, "pii")
    plain = _text(docs)
    added = _added(_bases(plain, stage), stage).withColumnsRenamed({"doc_id": "own_id", "text_hash": "own_hash"})
    # the row travels as one column, so no name of it can clash
    whole = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").cast("bigint").alias("id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = whole.join(
        added, F.col("id").eqNullSafe(F.col("own_id")) & (F.xxhash64("text") == F.col("own_hash")), "left"
    ).select("row", "text", "added")
    base = _slim(F.col("spans"))
    spans = F.when(F.col("added").isNull(), base).otherwise(F.array_sort(F.concat(base, F.col("added"))))
    found = _with_spans(rows).select("row", "text", spans.alias("spans"))
    placeholder = F.array(*(F.lit(f"[{k.upper()}]") for k in ORDER))
    text = F.col("text")

    def cut(acc: Column, s: Column) -> Column:
        part = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(placeholder, s["rank"]))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.array_append(acc["parts"], part)).otherwise(acc["parts"]).alias("parts"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    clean = F.aggregate(
        "spans",
        start,
        cut,
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))),
    )
    new = found.select("row", F.when(F.size("spans") > 0, clean).otherwise(text).alias("clean"))
    known = F.col("row.text").isNotNull()
    columns = {c: F.col("row").getField(c) for c in docs.columns}
    columns["text"] = F.when(known, F.col("clean"))
    if "n_chars" in columns:
        columns["n_chars"] = F.when(known, F.length("clean").cast("bigint")).otherwise(columns["n_chars"])
    return new.select(*(column.alias(name) for name, column in columns.items()))
