"""The quality gate: text signals, extractor grade, coverage, and the first of them that decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quire.constants import CONTENT_LEAST, COVERAGE_LEAST, GARBLED_MOST, LAYER_TOKENS_LEAST, LOW_GRADES, PRINTABLE_LEAST, RUN_REASON, WORD_LEAST
from quire.functions.text import GARBLED, has_run, ink, is_number, odd_tokens, on_one_line, printable_length, strip, tokens

SIGNALS = ("garbled_token_ratio", "mean_word_length", "dict_hit_rate", "has_repeated_char_run", "ascii_printable_ratio")

TOKEN_COUNTS = ("n_tokens", "n_garbled", "n_token_chars", "n_content")
COUNTS = "struct<n_tokens:int,n_garbled:int,n_token_chars:int,n_content:int,has_run:boolean,n_printable:int,n_chars:int>"


def text_counts(text: Column, of_tokens: Column | None = None, odd: Column | None = None) -> Column:
    """The integers behind the signals; of a null text as of an empty one. of_tokens, odd: its token_counts() and odd tokens, where they are at hand."""
    text = F.coalesce(text, F.lit(""))
    of_tokens = token_counts(text) if of_tokens is None else of_tokens
    odd = odd_tokens(text) if odd is None else odd
    n = of_tokens["n_tokens"]
    return F.struct(
        n.alias("n_tokens"), F.size(F.filter(odd, lambda t: t.rlike(GARBLED))).alias("n_garbled"),
        of_tokens["n_token_chars"].alias("n_token_chars"), (n - F.size(odd) + F.size(F.filter(odd, is_number))).alias("n_content"),
        has_run(text).alias("has_run"), printable_length(text).alias("n_printable"), F.length(text).alias("n_chars"),
    )


def token_counts(text: Column, line: Column | None = None, inked: Column | None = None) -> Column:
    """(n_tokens, n_token_chars). line, inked: on_one_line() of text and its ink(), where they are at hand; without ink it is split."""
    line = on_one_line(text) if line is None else line
    inked = ink(line) if inked is None else inked
    words = tokens(text)
    plain = F.struct(F.when(inked == 0, 0).otherwise(F.length(line) - inked + 1).alias("n_tokens"), inked.alias("n_token_chars"))
    return F.when(inked.isNotNull(), plain).otherwise(F.struct(F.size(words).alias("n_tokens"), F.length(F.array_join(words, "")).alias("n_token_chars")))


def carried_counts(text: Column, counts: Column) -> Column:
    """The counts of text from those of the same text with a space for each "\\n\\n": only runs of spaces may be broken, and each pair of
    line feeds, neither of which is printable, has stood for one printable character."""
    n = F.length(text)
    run = F.when(counts["has_run"], has_run(text)).otherwise(F.lit(False))
    return F.struct(*(counts[c].alias(c) for c in TOKEN_COUNTS), run.alias("has_run"), (counts["n_printable"] + counts["n_chars"] - n).alias("n_printable"), n.alias("n_chars"))


def signals_of(counts: Column) -> Column:
    """The five signals and the codes of those that fail, from text_counts(). A text without tokens fails as empty_text alone."""
    n, chars = counts["n_tokens"], counts["n_chars"]
    some = n > 0
    share = lambda x, of: F.when(some, x / of).otherwise(F.lit(0.0))
    garbled, length, content, printable = share(counts["n_garbled"], n), share(counts["n_token_chars"], n), share(counts["n_content"], n), share(counts["n_printable"], chars)
    run = some & counts["has_run"]
    failing = F.array_compact(F.array(
        F.when(garbled > GARBLED_MOST, SIGNALS[0]), F.when(length < WORD_LEAST, SIGNALS[1]), F.when(content < CONTENT_LEAST, SIGNALS[2]),
        F.when(run, SIGNALS[3]), F.when(printable < PRINTABLE_LEAST, SIGNALS[4]),
    ))
    return F.struct(
        garbled.alias(SIGNALS[0]), length.alias(SIGNALS[1]), content.alias(SIGNALS[2]), run.alias(SIGNALS[3]), printable.alias(SIGNALS[4]),
        F.when(some, failing).otherwise(F.array(F.lit("empty_text"))).alias("failing_signals"),
    )


def with_signals(df: DataFrame, text: str = "text", like: str | None = None) -> DataFrame:
    """df with struct columns counts and signals, and passes.

    What counts are made of goes through generators of one row, which projections aren't merged across: else each use would search the
    text again. like: a text whose counts are there as counts already; where text differs from it by line feeds for spaces only, its
    counts follow from them.
    """
    own = [F.col(f"`{c}`") for c in df.columns if c not in ("counts", "signals", "passes")]
    once = lambda *values: F.inline(F.array(F.struct(*values)))
    told, known = F.coalesce(F.col(text), F.lit("")), F.lit(None).cast(COUNTS)
    if like is not None:
        same = F.replace(told, F.lit("\n\n"), F.lit(" ")) == F.col(like)
        known = F.when(same, carried_counts(told, F.col("counts")))
    unknown = lambda make: F.when(F.col("_known").isNull(), make(told))
    out = df.select(*own, once(known.cast(COUNTS).alias("_known")))
    out = out.select(*own, "_known", once(unknown(on_one_line).alias("_line"), unknown(odd_tokens).alias("_odd")))
    out = out.select(*own, "_known", "_line", "_odd", once(ink(F.col("_line")).alias("_ink")))
    out = out.select(*own, "_known", "_odd", once(unknown(lambda t: token_counts(t, F.col("_line"), F.col("_ink"))).alias("_of")))
    out = out.select(*own, once(F.coalesce("_known", F.when(F.col("_known").isNull(), text_counts(F.col(text), F.col("_of"), F.col("_odd"))).cast(COUNTS)).alias("counts")))
    out = out.withColumn("signals", signals_of(F.col("counts")))
    return out.withColumn("passes", F.size("signals.failing_signals") == 0)


def decision(reason: Column, layer: int) -> Column:
    return F.struct(F.lit("promote_to_vlm").alias("action"), reason.alias("reason"), F.lit(layer).alias("layer"))


def grade_decision(low: Column, mean: Column) -> Column:
    """Promotion for a poor or fair grade, the low grade first; null otherwise."""
    bad = lambda g: F.lower(g).isin(*LOW_GRADES)
    reason = F.when(bad(low), F.concat(F.lit("docling_low_grade="), low)).when(bad(mean), F.concat(F.lit("docling_mean_grade="), mean))
    return F.when(reason.isNotNull(), decision(reason, 1))


def coverage_decision(extracted: Column, layer_tokens: Column) -> Column:
    """Promotion for a page of which under 30 % of a text layer of 30 or more tokens was extracted; null otherwise."""
    low = (layer_tokens >= LAYER_TOKENS_LEAST) & (extracted < F.lit(COVERAGE_LEAST) * layer_tokens)
    reason = F.format_string("low_coverage: extracted %d of %d text-layer tokens", extracted.cast("long"), layer_tokens.cast("long"))
    return F.when(low, decision(reason, 1))


def two_places(n: Column, d: Column) -> Column:
    """The double n / d of two integers (below 2 ** 20 or so) with two places, rounded exactly; Java's own formatting rounds what it prints of it.

    Only where n / d lies halfway in decimal does the double's own error decide; it is found without rounding in two halves of the double.
    """
    n, d = n.cast("long"), d.cast("long")
    # each step is an argument of the next one's lambda: written out, the steps would grow past what a method may hold
    bound = lambda value, then: F.get(F.transform(F.array(value), then), F.lit(0))
    near = F.floor(100 * n / d)

    def rounded(down: Column) -> Column:
        rest, value = 2 * (100 * n - down * d), n / d
        high = value.cast("float").cast("double")
        error = (high * 200 - (2 * down + 1)) + (value - high) * 200
        return down + F.when(rest != d, rest > d).when(error != 0, error > 0).otherwise(down % 2 == 1).cast("long")

    down = bound(near, lambda x: F.when(x * d > 100 * n, x - 1).when((x + 1) * d <= 100 * n, x + 1).otherwise(x).cast("long"))
    return bound(bound(down, rounded), lambda hundredths: F.concat(F.floor(hundredths / 100).cast("string"), F.lit("."), F.lpad((hundredths % 100).cast("string"), 2, "0")))


def signal_text(signals: Column, counts: Column) -> Column:
    """Failing signals with their values, comma-joined; a run of characters has none."""
    n, chars = counts["n_tokens"], counts["n_chars"]
    parts = {SIGNALS[0]: (counts["n_garbled"], n), SIGNALS[1]: (counts["n_token_chars"], n), SIGNALS[2]: (counts["n_content"], n), SIGNALS[4]: (counts["n_printable"], chars)}
    part = lambda s: parts.get(s, (F.lit(None).cast("int"), F.lit(None).cast("int")))
    rows = F.array(*(F.struct(F.lit(s).alias("name"), part(s)[0].cast("long").alias("n"), part(s)[1].cast("long").alias("d")) for s in SIGNALS))
    failing = F.filter(rows, lambda x: F.array_contains(signals["failing_signals"], x["name"]))
    told = F.transform(failing, lambda x: F.when(x["d"].isNull(), F.lit(RUN_REASON)).otherwise(F.concat(x["name"], F.lit("="), two_places(x["n"], x["d"]))))
    return F.when(n > 0, F.array_join(told, ", ")).otherwise(F.array_join(signals["failing_signals"], ", "))


def heuristic_decision(text: Column, signals: Column, counts: Column) -> Column:
    """Promotion for failing signals; null for a blank text, of which nothing is known."""
    fails = (strip(text) != "") & (F.size(signals["failing_signals"]) > 0)
    return F.when(fails, decision(F.concat(F.lit("heuristic_failed: "), signal_text(signals, counts)), 2))


def keep() -> Column:
    return F.struct(F.lit("keep").alias("action"), F.lit(None).cast("string").alias("reason"), F.lit(None).cast("int").alias("layer"))


def page_text() -> Column:
    """Aggregate: the non-empty texts of a page's elements (seq, text), in order: what the gate looks at.

    Only texts of elements count; the cells of tables, which carry no text, do not. Spaces join them, so its tokens are theirs.
    """
    kept = F.collect_list(F.when(F.coalesce(F.col("text"), F.lit("")) != "", F.struct("seq", F.col("text"))))
    return F.array_join(F.sort_array(kept)["text"], " ").alias("page_text")


def page_texts(elements: DataFrame) -> DataFrame:
    """(doc_id, page_index, page_text, extracted_tokens) from elements (doc_id, page_index, seq, text)."""
    return elements.groupBy("doc_id", "page_index").agg(page_text()).withColumn("extracted_tokens", F.size(tokens(F.col("page_text"))).cast("long"))


def gated(pages: DataFrame, grades: DataFrame | None = None, layers: DataFrame | None = None, one_based_grades: bool = False) -> DataFrame:
    """pages (doc_id, page_index, page_text) with decision: grade, then coverage, then heuristics, else keep; and the page_text's counts.

    What was extracted is the tokens of page_text, where pages have no extracted_tokens of their own.

    grades (doc_id, page_index, low_grade, mean_grade) and layers (doc_id, page_index, text_layer_tokens) are joined where given; else
    pages may have these columns themselves.
    one_based_grades takes a page's own grade, else that of the next index, as lookups by either convention do.
    """
    out = with_signals(pages, "page_text")
    out = out if "extracted_tokens" in pages.columns else out.withColumn("extracted_tokens", F.col("counts.n_tokens").cast("long"))
    key = ["doc_id", "page_index"]
    none = F.lit(None).cast("string")
    if grades is None:
        out = out.withColumns({c: none for c in ("low_grade", "mean_grade") if c not in pages.columns})
    else:
        out = out.drop("low_grade", "mean_grade").join(grades.select(*key, "low_grade", "mean_grade", F.lit(True).alias("_own")), key, "left")
        if one_based_grades:
            after = grades.select("doc_id", (F.col("page_index") - 1).alias("page_index"), F.col("low_grade").alias("_low"), F.col("mean_grade").alias("_mean"))
            out = out.join(after, key, "left")
            out = out.withColumns({"low_grade": F.when(F.col("_own"), F.col("low_grade")).otherwise(F.col("_low")), "mean_grade": F.when(F.col("_own"), F.col("mean_grade")).otherwise(F.col("_mean"))}).drop("_low", "_mean")
        out = out.drop("_own")
    if layers is not None:
        out = out.drop("text_layer_tokens").join(layers.select(*key, "text_layer_tokens"), key, "left")
    elif "text_layer_tokens" not in pages.columns:
        out = out.withColumn("text_layer_tokens", F.lit(None).cast("long"))
    return out.withColumn("decision", F.coalesce(
        grade_decision(F.col("low_grade"), F.col("mean_grade")), coverage_decision(F.col("extracted_tokens"), F.col("text_layer_tokens")),
        heuristic_decision(F.col("page_text"), F.col("signals"), F.col("counts")), keep(),
    ))
