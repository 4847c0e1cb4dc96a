"""Personal data by bootstrapped contextual extraction, DataFrame functions only.

Seed entities are what the fixed expressions find. The words before an entity
are a lexical pattern; the same patterns also stand before identifier-like
tokens that no expression knows. Spark scores the bipartite graph of patterns
and instances in rounds: a pattern is as reliable as the share of its
occurrences that are believed entities of a kind, an unknown instance is as
credible as its best pattern, or sure where its text is a seed elsewhere. What
is believed backs patterns by its belief, so a round can add patterns that the
seeds alone don't reach; where a context has too little support, its last word
speaks. Credible instances become spans wherever they stand. The graph holds
occurrences only, never texts; every round is combined aggregations and
equi-joins, written as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import CHUNK, Scratch

#: Kinds in the order in which spans of equal start are listed.
KINDS = ["email", "ip", "card", "phone"]
# Fixed expressions, written so that no start is tried twice: classes that
# cannot give back characters are possessive, and a run is entered at its
# beginning or where the last match ended. They match what the plain forms match:
#   [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   [0-9]([\x20-]?[0-9])+
#   \+[0-9][\x20().0-9-]+[0-9]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this character has no match (digits have no single one).
MARKS = {"email": "@", "phone": "+"}
#: Identifier-like tokens: runs of these characters with five digits or an @.
TOKEN = r"(?<![A-Za-z0-9@._%+()-])(?=(?:[A-Za-z@._%+()-]*+[0-9]){5}|[A-Za-z0-9._%+()-]*+@)[A-Za-z0-9@._%+()-]++"
#: Identifiers written in groups: two or more groups of digits, brackets, dots
#: and hyphens with one space between, five digits in all (the expression looks
#: ahead for them, also past the last group: ``grouped`` counts again).
GROUP = r"[(+]*+[0-9]++(?:[().+-]++[0-9]++)*+\)?+(?![().+-]*+[A-Za-z0-9@_%])"
GROUPS = r"(?<![A-Za-z0-9@._%+()-])(?=(?:[().+-]*+(?:\x20[().+-]*+)?+[0-9]){5})" + GROUP + r"(?:\x20" + GROUP + r")++"
#: A group token that begins with a whole token of its own.
LED = r"^(?:[().+-]*+[0-9]){5}[^\x20]*+\x20"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
PLACE = "array<struct<start: int, kind: int, end: int>>"
SPAN = "array<struct<start: int, end: int, text: string>>"


#: Elements of an array that are worked on together, and code points of a piece
#: of text: work on a text grows with its length and matches, not their product.
RUN, PIECE = 64, 4096


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once (the variable of a lambda)."""
    return F.transform(F.array(value), use)[0]


def runs(values: Column) -> Column:
    """An array, not empty, as an array of arrays of up to RUN elements."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / RUN).cast("int")), lambda i: F.slice(values, i * RUN + 1, RUN))


def carried(values: Column, first: Column, step, kind: str) -> Column:
    """What a fold over ``values`` has before each of them (one more at the end)."""
    start = F.struct(first.alias("now"), F.array(first).alias("all"))

    def add(state, v):
        now = step(state["now"], v)
        return F.struct(now.alias("now"), F.concat(state["all"], F.array(now)).alias("all"))

    return F.aggregate(values, start, add, lambda state: state["all"].cast(f"array<{kind}>"))


def pieces(text: Column) -> Column:
    """A text in pieces of PIECE code points."""
    return F.when(F.length(text) <= PIECE, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % PIECE), F.lit(0)))


def stretch(parts: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of a text given in pieces."""
    a, b = F.floor(start / PIECE).cast("int"), F.floor(end / PIECE).cast("int")
    at = start % PIECE + 1
    head, tail = F.coalesce(F.get(parts, a), F.lit("")), F.coalesce(F.get(parts, b), F.lit(""))
    middle = F.when(b > a + 1, F.array_join(F.slice(parts, a + 2, F.greatest(b - a - 1, F.lit(0))), "")).otherwise(F.lit(""))
    return F.when(a == b, F.substring(head, at, end - start)).otherwise(F.concat(F.substring(head, at, F.lit(PIECE)), middle, F.substring(tail, F.lit(1), end % PIECE)))


def found(text: Column, expression: str, guard: Column) -> Column:
    """Matches with code-point offsets: what stands between the matches gives
    their places, counted in runs of matches and then over the runs."""
    none = F.array().cast(SPAN)
    hits = F.when(guard, F.regexp_extract_all(text, F.lit(expression), F.lit(0))).otherwise(F.array().cast("array<string>"))
    between = F.split(text, expression, -1)
    size = lambda p: F.length(p["gap"]) + F.length(p["hit"])

    def spans(run, before):  # of a run that begins at ``before``
        ends = carried(run, before, lambda now, p: now + size(p), "int")
        return F.zip_with(run, F.slice(ends, 2, RUN), lambda p, end: F.struct((end - F.length(p["hit"])).alias("start"), end.alias("end"), p["hit"].alias("text")))

    def placed(blocks):
        lengths = F.transform(blocks, lambda run: F.aggregate(run, F.lit(0), lambda n, p: n + size(p)))
        begins = F.slice(carried(lengths, F.lit(0), lambda now, n: now + n, "int"), F.lit(1), F.size(blocks))
        return F.flatten(F.zip_with(blocks, begins, spans))

    def paired(h):
        return runs_of(F.arrays_zip(F.slice(between, 1, F.size(h)).alias("gap"), h.alias("hit")))

    def runs_of(pairs):
        return bound(pairs, lambda p: bound(runs(p), placed))

    # bound, the matches are searched once
    return bound(hits, lambda h: F.when(F.size(h) > 0, paired(h)).otherwise(none))


def free_of(tokens: Column, spans: Column) -> Column:
    """The tokens that overlap none of the spans (each has start and end): runs
    of both meet where their ranges do."""

    def ranged(values):
        return F.transform(runs(values), lambda r: F.struct(F.array_min(F.transform(r, lambda s: s["start"])).alias("start"), F.array_max(F.transform(r, lambda s: s["end"])).alias("end"), r.alias("all")))

    meets = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])

    def left(run, blocks):
        near = F.flatten(F.transform(F.filter(blocks, lambda b: meets(run, b)), lambda b: b["all"]))
        return bound(near, lambda n: F.filter(run["all"], lambda t: ~F.exists(n, lambda s: meets(t, s))))

    kept = bound(ranged(spans), lambda blocks: F.flatten(F.transform(ranged(tokens), lambda run: left(run, blocks))))
    return F.when((F.size(tokens) > 0) & (F.size(spans) > 0), kept).otherwise(tokens)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def grouped(text: Column) -> Column:
    return F.filter(found(text, GROUPS, F.lit(True)), lambda t: F.length(digits(t["text"])) >= 5)


def luhn(number: Column) -> Column:
    n = F.length(number)

    def worth(i):  # i-th digit from the right, from 1
        d = F.substring(number, n - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + worth(i)) % 10 == 0


def valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        return text.rlike(OCTETS)
    if kind == "card":
        n = F.length(digits(text))
        return F.when(n.between(14, 19), luhn(digits(text))).otherwise(False)
    if kind == "phone":
        return F.length(digits(text)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end, text) of the fixed expressions, sorted by
    start and then kind (a number: its place in KINDS)."""
    return F.array_sort(F.concat(*[of_kind(text, i) for i in range(len(KINDS))]))


def of_kind(text: Column, i: int) -> Column:
    kind = KINDS[i]
    guard = F.contains(text, F.lit(MARKS[kind])) if kind in MARKS else F.lit(True)
    spans = F.filter(found(text, PATTERNS[kind], guard), lambda s: valid(kind, s["text"]))
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("kind"), s["end"].alias("end"), s["text"].alias("text")))


def count_of(i: int) -> Column:
    return F.size(F.filter("base", lambda b: b["kind"] == i)).cast("long").alias(f"n_{KINDS[i]}")


def left_context(parts: Column, start: Column, words: int, reach: int) -> Column:
    """The last ``words`` words within ``reach`` characters before ``start`` of
    a text in pieces (and what touches it), lower-cased, digits as 0; a '^' first where the text
    begins before there are as many."""
    before = stretch(parts, F.greatest(start - reach, F.lit(0)), start)
    plain = F.regexp_replace(F.lower(before), "[0-9]", "0")
    tail = F.regexp_extract(plain, r"(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){0,%d}[^\x20\x09-\x0D]*$" % words, 0)
    parts = F.filter(F.split(tail, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    few = (F.size(parts) < words) & (start <= reach)
    return F.array_join(F.concat(F.when(few, F.array(F.lit("^"))).otherwise(F.array().cast("array<string>")), parts), " ")


def listed(spans: Column) -> Column:
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def occurrence_table(rows: DataFrame, words: int, reach: int, scratch: Scratch) -> DataFrame:
    """``row``, ``doc_id``, base spans and, with their left contexts, all base
    spans and unknown identifier-like tokens of rows (row, doc_id, text): single
    runs and groups, also where a group holds such a run."""
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("base", base_spans(F.col("text"))).withColumn("tokens", F.concat(found(F.col("text"), TOKEN, F.lit(True)), grouped(F.col("text"))))
    rows = rows.withColumn("free", free_of(F.col("tokens"), F.col("base"))).withColumn("pieces", pieces(F.col("text")))

    def entry(s, kind):
        context = left_context(F.col("pieces"), s["start"], words, reach)
        return F.struct(s["start"].alias("start"), kind.cast("int").alias("kind"), s["end"].alias("end"), s["text"].alias("text"), context.alias("context"))

    seen = F.concat(F.transform("base", lambda b: entry(b, b["kind"])), F.transform("free", lambda t: entry(t, F.lit(None))))
    narrow = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end")))
    return scratch.table(rows.select("row", "doc_id", narrow.alias("base"), seen.alias("seen")))


def added_spans(table: DataFrame, rounds: int, reliable: float, support: int, scratch: Scratch) -> DataFrame:
    """(row, added array<struct<start, kind, end>>) from scoring the graph."""
    shape = F.when(F.contains("text", F.lit("@")), F.lit("@ ")).otherwise(F.lit("# "))
    seen = table.select("row", F.explode("seen").alias("s")).select("row", "s.*").withColumn("pattern", F.concat(shape, F.col("context")))
    # edges of the graph: how often an instance stands behind a context; a group
    # that begins with a token of its own is the same place, counted with that
    again = F.col("kind").isNull() & F.col("text").rlike(LED)
    whole = scratch.table(seen.groupBy("pattern", "text", "kind").agg(F.sum(F.when(again, 0).otherwise(1)).alias("n")))
    # the last word alone is a pattern too; '~' tells it from whole contexts
    last = F.regexp_extract("pattern", r"^(?:@|#)\x20.*\x20([^\x20]+)$", 1)
    short = F.when(last != "", F.concat(F.substring("pattern", 1, 1), F.lit("~"), last))
    both = F.explode(F.array_compact(F.array("pattern", short)))
    edges = scratch.table(whole.select(both.alias("pattern"), "text", "kind", "n").groupBy("pattern", "text", "kind").agg(F.sum("n").alias("n")))
    totals = scratch.table(edges.groupBy("pattern").agg(F.sum("n").alias("total")))
    known = edges.where("kind is not null").withColumn("belief", F.lit(1.0))
    unknown = edges.where("kind is null").drop("kind")
    waiting = scratch.table(whole.where("kind is null").select("pattern", short.alias("short"), "text"))
    contexts = waiting.select("pattern", "short").distinct()
    reach = contexts.select(F.col("pattern").alias("of"), F.explode(F.array_compact(F.array(F.struct(F.lit(2).alias("rank"), "pattern"), F.when(F.col("short").isNotNull(), F.struct(F.lit(1).alias("rank"), F.col("short").alias("pattern")))))).alias("p"))
    reach = reach.select("of", "p.rank", "p.pattern")
    # an unknown token whose text is an entity elsewhere is as sure as that one
    same = scratch.table(waiting.select("text").distinct().join(known.select("text", "kind").distinct(), "text").withColumn("belief", F.lit(1.0)))
    beliefs = same
    for _ in range(rounds):
        votes = known.unionByName(unknown.where("n > 0").join(beliefs, "text").select(*known.columns))
        # an instance counts once towards the support of a pattern, by its belief
        votes = votes.groupBy("pattern", "kind", "text").agg(F.sum(F.col("n") * F.col("belief")).alias("votes"), F.max("belief").alias("belief"))
        scored = votes.groupBy("pattern", "kind").agg(F.sum("votes").alias("votes"), F.sum("belief").alias("backing"))
        scored = scored.where(F.col("backing") >= support).join(totals, "pattern")
        patterns = scored.select("pattern", "kind", (F.col("votes") / (F.col("total") + 1)).alias("score"))
        # the longest context with support speaks (at most two scores a kind)
        heard = reach.join(patterns, "pattern").groupBy("of").agg(F.collect_list(F.struct("rank", "kind", "score")).alias("all"))
        heard = heard.withColumn("top", F.array_max(F.transform("all", lambda s: s["rank"])))
        heard = heard.select(F.col("of").alias("pattern"), F.explode(F.filter("all", lambda s: s["rank"] == F.col("top"))).alias("s")).select("pattern", "s.kind", "s.score")
        # an unknown instance is as credible as its best pattern, and votes with that
        heard = waiting.join(heard, "pattern").select("text", "kind", F.col("score").alias("belief")).unionByName(same)
        beliefs = scratch.table(heard.groupBy("text", "kind").agg(F.max("belief").alias("belief")))
    best = beliefs.where(F.col("belief") >= reliable).groupBy("text").agg(F.min(F.struct(-F.col("belief"), "kind")).alias("first"))
    news = seen.where("kind is null").drop("kind").join(best, "text")
    # of a group and the tokens in it, the group
    before = Window.partitionBy("row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    news = news.withColumn("to", F.max(F.when(F.contains("text", F.lit(" ")), F.col("end"))).over(before)).where("to is null or to <= start")
    return news.groupBy("row").agg(F.collect_list(F.struct("start", F.col("first.kind").alias("kind"), "end")).alias("added"))


def find_personal_data(docs: DataFrame, words: int = 2, reach: int = 40, rounds: int = 3, reliable: float = 0.8, support: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every
    row of ``docs``; the counts and the digest are those of the fixed
    expressions, ``spans`` also lists what the patterns add (with the kind of
    the seeds that vouch for it).

    A pattern is the last ``words`` words in the ``reach`` characters before an
    entity, or the last one where those have no score; apart for tokens with and
    without an @. It has a score when distinct instances of one kind, seeds as 1
    and unknown ones by their belief, add up to ``support``: their believed share
    of all its occurrences plus one. An unknown token is a span, wherever it
    stands, when its best pattern scores ``reliable`` in the last of ``rounds``
    rounds or its text is a seed elsewhere. Null and empty texts
    have no spans; repeated rows count (and vouch) each; null ids stay null;
    other columns are ignored; an empty table gives no rows."""
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = occurrence_table(rows, words, reach, scratch)
    added = added_spans(table, rounds, reliable, support, scratch)
    out = table.select("row", "doc_id", "base").join(added, "row", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(PLACE))))
    counts = [count_of(i) for i in range(len(KINDS))]
    return out.select("doc_id", *counts, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(spans).alias("spans"))


def redact(docs: DataFrame, words: int = 2, reach: int = 40, rounds: int = 3, reliable: float = 0.8, support: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in angle
    brackets (of overlapping spans the first names the whole stretch); texts
    without spans, nulls included, stay as they are."""
    scratch = Scratch(docs.sparkSession)
    renamed = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    id_at, text_at = (f"c{docs.columns.index(c)}" for c in (id_col, text_col))
    kept = scratch.chunked(renamed)
    rows = kept.select((F.col("_chunk") * CHUNK + F.col("_bit")).alias("row"), F.col(id_at).cast("long").alias("doc_id"), F.col(text_at).cast("string").alias("text"))
    table = occurrence_table(rows, words, reach, scratch)
    added = added_spans(table, rounds, reliable, support, scratch)
    spans = table.select("row", "base").join(added, "row", "left")
    spans = spans.select("row", F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(PLACE)))).alias("spans")).where(F.size("spans") > 0)
    # per chunk, the spans of its rows that have any
    entry = F.struct((F.col("row") % CHUNK).cast("int").alias("bit"), "spans")
    marked = spans.groupBy(F.floor(F.col("row") / CHUNK).alias("_chunk")).agg(F.collect_list(entry).alias("_marked"))
    marked = scratch.table(marked).hint("shuffle_hash")
    own = F.get(F.filter("_marked", lambda m: m["bit"] == F.col("_bit")), F.lit(0))["spans"]
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    text = F.col(text_at).cast("string")

    def cut(parts, spans):  # overlapping spans only move the end of the first
        tops = lambda run: F.array_max(F.transform(run, lambda x: x["end"]))

        def pairs(run, before):  # what each span that begins a stretch brings: the text before it and its name
            ends = carried(run, before, lambda now, x: F.greatest(now, x["end"]), "int")
            both = F.arrays_zip(run.alias("span"), F.slice(ends, F.lit(1), F.size(run)).alias("to"))
            heads = F.filter(both, lambda p: p["span"]["start"] >= p["to"])
            return F.array_join(F.transform(heads, lambda p: F.concat(stretch(parts, p["to"], p["span"]["start"]), F.get(names, p["span"]["kind"]))), "")

        def joined(blocks):
            to = carried(F.transform(blocks, tops), F.lit(0), lambda now, top: F.greatest(now, top), "int")
            return bound(to, lambda t: F.concat(F.array_join(F.zip_with(blocks, F.slice(t, F.lit(1), F.size(blocks)), pairs), ""), stretch(parts, F.element_at(t, -1), F.length(text))))

        return bound(runs(spans), joined)

    clean = F.when(F.col("spans").isNull(), text).otherwise(bound(pieces(text), lambda parts: cut(parts, F.col("spans"))))
    out = kept.join(marked, "_chunk", "left").withColumn("spans", own)
    return out.select(*[clean.alias(c) if c == text_at else F.col(c) for c in renamed.columns]).toDF(*docs.columns)
