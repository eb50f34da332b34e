"""Lines that recur across documents, found by a log-template tree of fixed depth.

A line's tokens are split at white space; a token with a digit is a variable field ``<*>``. The
tree's first level is the number of tokens, the next levels are the leading tokens. In a leaf, a
template is either all tokens, or all but one run of neighbouring tokens (a quarter of those after
the leading ones), which is then one more variable field. A template's path is hashed to a key, so
the tree is never built in memory: counting documents by key is an aggregation with map-side
combination, and neither the order of lines nor the size of a leaf matters.

A line goes if one of its templates stands in enough documents and an earlier line has it: the
first line of a template stays. Two documents can be enough for a long line that is the same in both. Documents with the same text count once, so that whole copies, which
are no templates, are left to near-duplicate removal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnrisk.llm.common import free_name
from txnrisk.llm.steps import Steps

FIELD = "<*>"
PARTS = 4


RAW = r"split(trim(regexp_replace(line, r'\s+', ' ')), ' ')"


def without_part(tokens: str, lead: int, part: str) -> tuple[str, str]:
    """The tokens before and after one quarter of those that come after the leading ones."""
    start = f"{lead} + (size({tokens}) - {lead}) * {part} div {PARTS}"
    stop = f"{lead} + (size({tokens}) - {lead}) * ({part} + 1) div {PARTS}"
    return f"slice({tokens}, 1, cast({start} AS int))", f"slice({tokens}, cast({stop} AS int) + 1, size({tokens}))"


def template_keys(lead: int, general: int) -> str:
    """Keys of the templates of ``tokens``: of all, and for longer lines without one quarter."""
    whole = "xxhash64(-1, size(tokens), tokens)"
    parts = []
    for part in range(PARTS):
        before, after = without_part("tokens", lead, str(part))
        parts.append(f"xxhash64({part}, size(tokens), {before}, {after})")
    return f"IF(size(tokens) >= {general}, array({whole}, {', '.join(parts)}), array({whole}))"


def few_constants(lead: int) -> str:
    """Whether the constant tokens fit into one quarter: only then can a template be without them."""
    return f"constants <= greatest(size(tokens) - {lead}, 0) div {PARTS} + 1"


def constant_keys(lead: int, general: int) -> str:
    """As ``template_keys``, but templates of fields only are of the line's own tokens, ``raw``.

    ``raw`` may be null where constant tokens do not fit into one quarter.
    """
    before, after = without_part("tokens", lead, "part")
    raw = f"xxhash64(part, size(raw), {', '.join(without_part('raw', lead, 'part'))})"
    key = f"xxhash64(part, size(tokens), {before}, {after})"
    bare = f"size(array_remove(concat({before}, {after}), '{FIELD}')) = 0"
    parts = f"transform(sequence(0, {PARTS - 1}), part -> IF({bare}, {raw}, {key}))"
    few = f"size(tokens) >= {general} AND {few_constants(lead)}"
    return (
        f"CASE WHEN constants = 0 THEN array(xxhash64(-2, size(tokens), raw)) "
        f"WHEN {few} THEN concat(array(xxhash64(-1, size(tokens), tokens)), {parts}) "
        f"ELSE {template_keys(lead, general)} END"
    )


def content() -> list[Column]:
    """Two hashes that stand for a text."""
    return [F.xxhash64("text").alias("c1"), F.xxhash64(F.lit(1), "text").alias("c2")]


def drop_recurring(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    documents: int = 3,
    lead: int = 3,
    least: int = 3,
    general: int = 12,
    dropped: str | None = None,
    characters: int | None = None,
    constants: bool = False,
    pair: int | None = None,
) -> DataFrame:
    """``df`` with the recurring lines cut out of ``text``; documents of which nothing is left go.

    A template recurs when documents with at least ``documents`` different texts have it. Of its
    lines the one of the document with the least ``key`` (null keys last), and there the first, is
    kept, in all copies of that document. Lines with fewer than ``least`` tokens always stay, so do
    blank lines; ``general``: least tokens of a line whose quarters may vary; ``lead``: leading
    tokens that never do. ``dropped``: name of an added column with the number of lines cut.
    ``characters``: a line of so many characters recurs, as it is, even with fewer than ``least`` tokens.
    ``constants``: lines and templates of fields only recur by their own tokens, so only equal rows do.
    ``pair``: least tokens of a line for which two different texts are enough, if all its tokens are the same.

    Lines end with a line feed; the lines kept are joined by line feeds, unchanged. Null and empty
    texts have no lines and their rows stay. Repeated rows stay or go together. All other columns
    are passed on; one that is named like ``dropped`` is replaced.
    """
    steps = Steps(df.sparkSession, "lines")
    texts = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    lines = texts.select("key", *content(), F.posexplode(F.split("text", "\n")).alias("at", "line"))
    masked = F.trim(F.regexp_replace(F.regexp_replace("line", r"[^\s]*[0-9][^\s]*", FIELD), r"\s+", " "))
    lines = lines.withColumn("tokens", F.split(masked, " ")).withColumn("long", F.size("tokens") >= least)
    # A line's own tokens are split only where a key needs them.
    needed = "NOT long"
    if constants:
        lines = lines.withColumn("constants", F.expr(f"size(array_remove(tokens, '{FIELD}'))"))
        needed = f"NOT long OR {few_constants(lead)}"
    if constants or characters is not None:
        lines = lines.withColumn("raw", F.expr(f"IF({needed}, {RAW}, NULL)"))
    keys = F.when(F.col("long"), F.expr(constant_keys(lead, general) if constants else template_keys(lead, general)))
    if characters is not None:
        wide = F.expr(f"length(array_join(raw, ' ')) >= {characters}")
        keys = keys.when(wide, F.expr("array(xxhash64(-2, size(tokens), raw))"))
    # Texts that a line needs as it is; templates with a variable quarter need ``documents``.
    enough = F.lit(documents) if pair is None else F.when(F.size("tokens") >= pair, min(2, documents)).otherwise(documents)
    lines = lines.select("key", "c1", "c2", "at", keys.alias("keys"), enough.cast("tinyint" if documents < 128 else "int").alias("enough"))
    owner = F.min(F.struct(F.col("key").isNull().alias("none"), "key"))
    lines = lines.groupBy("c1", "c2", "at").agg(owner.alias("owner"), F.first("keys").alias("keys"), F.first("enough").alias("enough"))
    lines = steps.put("lines", lines)

    found = lines.select(F.posexplode("keys").alias("place", "template"), "c1", "c2", "at", "owner", "enough")
    found = found.withColumn("enough", F.expr(f"IF(place = 0, enough, {documents})"))
    in_document = found.groupBy("template", "c1", "c2").agg(
        F.min(F.struct("owner", "c1", "c2", "at")).alias("first"), F.min("enough").alias("enough")
    )
    counts = in_document.groupBy("template").agg(
        F.count(F.lit(1)).alias("n"), F.min("first").alias("first"), F.min("enough").alias("enough")
    )
    recurring = counts.where("n >= enough")
    recurring = recurring.select("template", *(F.col(f"first.{c}").alias(f"first_{c}") for c in ("c1", "c2", "at")))
    recurring = steps.put("recurring", recurring)

    later = F.expr("c1 <> first_c1 OR c2 <> first_c2 OR at <> first_at")
    cut = found.drop("owner", "place", "enough").join(recurring, "template").where(later).select("c1", "c2", "at").distinct()
    cut = steps.put("cut", cut.withColumn("goes", F.lit(True)))
    touched = cut.select("c1", "c2").distinct()
    flags = lines.select("c1", "c2", "at").join(touched, ["c1", "c2"], "left_semi").join(cut, ["c1", "c2", "at"], "left")
    flags = flags.groupBy("c1", "c2").agg(F.array_sort(F.collect_list(F.struct("at", "goes"))).alias("flags"))
    flags = steps.put("flags", flags.select("c1", "c2", F.col("flags.goes").alias("goes")))
    steps.drop("lines", "recurring", "cut")

    names = [c for c in df.columns if dropped is None or c.lower() != dropped.lower()]
    row = free_name(["c1", "c2", "goes", "text"], "row")
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias(row), F.col(f"`{text}`").alias("text"))
    rows = rows.select(row, "text", *content()).join(flags, ["c1", "c2"], "left")
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.coalesce(F.element_at("goes", i + 1), F.lit(False)))
    rows = rows.withColumn("kept", F.when(F.col("goes").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("text")))
    rows = rows.where(F.col("goes").isNull() | (F.regexp_replace("kept", r"\s+", "") != ""))
    out = [F.col("kept").alias(c) if c == text else F.col(f"{row}.`{c}`").alias(c) for c in names]
    if dropped:
        number = F.size(F.filter("goes", lambda g: g))
        out.append(F.coalesce(F.when(F.col("goes").isNotNull(), number), F.lit(0)).cast("long").alias(dropped))
    return rows.select(*out)
