"""Line dedup by site-relative frequency: lines on too large a share of a host's pages go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import stored

RATIO = 0.1
MIN_PAGES = 20
# Bytes of all boilerplate lines up to which they are broadcast.
BROADCAST_BYTES = 4 << 20


def url_host(url: Column | str) -> Column:
    """Lower-case host of a URL; empty where there is none."""
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def html_lines(html: Column | str) -> Column:
    """Text of a page with a line break for each tag, without scripts, styles and comments."""
    bare = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", "")
    return F.regexp_replace(bare, r"(?:<[^>]*>)+", "\n")


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), lambda line: F.trim(line))


def drop_site_boilerplate(
    pages: DataFrame, host: str, text: str, ratio: float = RATIO, min_pages: int = MIN_PAGES, least: int = 1
) -> DataFrame:
    """The given rows and columns with boilerplate lines taken out of `text`, plus `lines` and `dropped_lines`.

    A line is boilerplate on a host if more than `ratio` of the host's pages hold it, on hosts of at
    least `min_pages` pages, and at least `least` pages do. Lines count once a page, after trimming spaces; blank lines are neither
    counted nor dropped. A row without a host keeps all lines; a null text stays null and counts as a
    page with none. Equal rows stay equal rows; the added columns replace columns of those names.

    Rows meet a line only as counts made before the shuffle, so a hot host or line costs a row a task.
    A host has at most (lines a page) / ratio boilerplate lines; they reach its rows as one array.
    """
    own = pages.select(F.col(host).alias("host"), F.col(text).alias("text")).filter("host IS NOT NULL")
    totals = own.groupBy("host").agg(F.count("*").alias("pages"))
    found = (
        own.select("host", F.explode(F.array_distinct(_lines(F.col("text")))).alias("line"))
        .filter("line <> ''")
        .groupBy("host", "line")
        .agg(F.count("*").alias("holding"))
    )
    # A line on so many pages stands on as many at least; the rest never reaches the join.
    often = found.filter((F.col("holding") > F.lit(ratio) * F.lit(min_pages)) & (F.col("holding") >= least))
    often = often.join(totals, "host")
    often = often.filter((F.col("pages") >= min_pages) & (F.col("holding") > F.lit(ratio) * F.col("pages")))
    boilerplate = stored(often.groupBy("host").agg(F.collect_list("line").alias("lines")), "boilerplate")
    size = boilerplate.agg(F.sum(F.length(F.concat_ws("", "lines")) + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        boilerplate = F.broadcast(boilerplate)

    names = [c for c in pages.columns if c not in ("lines", "dropped_lines")]
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(host).alias("host"))
    rows = rows.join(boilerplate, "host", "left")
    every = F.split(F.col("row")[text], "\n")
    kept = F.when(F.col("lines").isNull(), every).otherwise(
        F.filter(every, lambda line: ~F.array_contains(F.col("lines"), F.trim(line)))
    )
    rows = rows.select("row", every.alias("every"), kept.alias("kept"))
    columns = [
        F.array_join("kept", "\n").alias(c) if c == text else F.col("row")[c].alias(c) for c in names
    ]
    return rows.select(
        *columns,
        F.coalesce(F.size("every"), F.lit(0)).alias("lines"),
        F.coalesce(F.size("every") - F.size("kept"), F.lit(0)).alias("dropped_lines"),
    )


# What the documents' form of the operator asks of a line; see drop_shared_lines.
SHARED_RATIO, SHARED_LEAST = 0.01, 3
LONG_WORDS, EDGE_LINES = 8, 3
MOST_CUT = 0.5
# Rights of use are part of a text, however many share the line.
RIGHTS = r"(?i)\blicen[sc]e|\bcopyright\b|\(c\)|©|\brights reserved\b|\bspdx-"
# Lines of a program: indented, ended by a bracket or semicolon, or opened by a word of a programming language.
CODE_LINE = r"^(\t| {2,})\s*\S|[{};]\s*$|^\s*(def|class|import|from|return|if|else|for|while|#include|package|public|private|func|fn|var|let|const)\b"
CODE_SHARE = 0.5


def drop_shared_lines(
    rows: DataFrame,
    host: str,
    text: str,
    ratio: float = SHARED_RATIO,
    least: int = SHARED_LEAST,
    long_words: int = LONG_WORDS,
    edge_lines: int = EDGE_LINES,
    most_cut: float = MOST_CUT,
) -> DataFrame:
    """The given rows and columns with lines that a host's texts share taken out of `text`, plus `lines` and `dropped_lines`.

    A line goes if more than `ratio` of the host's different texts hold it, `least` at least, and it has
    `long_words` words or stands, in half of them at least, among a text's first or last `edge_lines`
    lines; a short line from the middle is content. Equal texts count once, so no text is boilerplate
    for being copied. Lines about rights of use, and texts of which half the lines are a program's, stay
    and count for nothing. A text that would lose more than `most_cut` of its lines keeps them all: it
    is a near copy, or nothing would be left of it. Lines are compared without outer spaces, by 64-bit
    fingerprints; blank ones are neither counted nor dropped.

    A row without a host keeps all lines; a null text stays null. Equal rows stay equal rows; the added
    columns replace columns of those names; an empty table gives an empty one. Only fingerprints are
    shuffled, and copies collapse before that; a hot line or host costs a row a task.
    """
    every = F.split(F.col("text"), "\n")
    solid = F.filter(F.transform(every, lambda line: F.trim(line)), lambda line: line != "")
    code = F.size(F.filter(every, lambda line: (F.trim(line) != "") & line.rlike(CODE_LINE))) >= CODE_SHARE * F.size("solid")
    own = rows.select(F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").cast("string").alias("text"))
    own = own.filter("host IS NOT NULL AND text IS NOT NULL").withColumn("solid", solid).withColumn("code", code)
    own = own.filter(~F.col("code")).withColumn("name", F.xxhash64("text"))
    texts = own.groupBy("host", "name").agg(F.count("*").alias("n")).groupBy("host").agg(F.count("*").alias("texts"))
    ends = F.concat(F.slice("solid", 1, edge_lines), F.slice(F.reverse("solid"), 1, edge_lines))
    marked = F.transform(
        F.filter(F.array_distinct("solid"), lambda line: ~line.rlike(RIGHTS)),
        lambda line: F.struct(
            F.xxhash64(line).alias("line"),
            (F.size(F.split(line, r"\s+")) >= long_words).cast("int").alias("long"),
            F.array_contains(F.col("ends"), line).cast("int").alias("edge"),
        ),
    )
    found = own.withColumn("ends", ends).select("host", "name", F.inline(marked))
    found = found.groupBy("host", "line", "name").agg(F.max("long").alias("long"), F.max("edge").alias("edge"))
    found = found.groupBy("host", "line").agg(F.count("*").alias("holding"), F.max("long").alias("long"), F.sum("edge").alias("edge"))
    found = found.filter((F.col("holding") >= least) & ((F.col("long") == 1) | (2 * F.col("edge") >= F.col("holding"))))
    found = found.join(texts, "host").filter(F.col("holding") > F.lit(ratio) * F.col("texts"))
    shared = stored(found.groupBy("host").agg(F.collect_list("line").alias("gone")), "shared-lines")
    size = shared.agg(F.sum(8 * F.size("gone") + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        shared = F.broadcast(shared)

    names = [c for c in rows.columns if c.lower() not in ("lines", "dropped_lines")]
    held = rows.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").cast("string").alias("text")
    )
    held = held.join(shared, "host", "left").withColumn("solid", solid).withColumn("code", code)
    stays = F.filter(every, lambda line: (F.trim(line) == "") | ~F.array_contains(F.col("gone"), F.xxhash64(F.trim(line))) | F.trim(line).rlike(RIGHTS))
    held = held.select("row", every.alias("every"), "solid", F.when(F.col("gone").isNull() | F.col("code"), every).otherwise(stays).alias("stays"))
    cut = F.size("every") - F.size("stays")
    stays = F.when(cut > most_cut * F.size("solid"), F.col("every")).otherwise(F.col("stays"))
    held = held.select("row", "every", stays.alias("stays"))
    columns = [F.array_join("stays", "\n").alias(c) if c == text else F.col("row")[c].alias(c) for c in names]
    return held.select(
        *columns,
        F.when(F.col("every").isNull(), 0).otherwise(F.size("every")).alias("lines"),
        F.when(F.col("every").isNull(), 0).otherwise(F.size("every") - F.size("stays")).alias("dropped_lines"),
    )
