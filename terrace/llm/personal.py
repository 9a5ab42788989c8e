"""Personal data: fixed forms, and forms that their contexts betray.

Seeds are what four fixed expressions find. Words in a row that hold a digit or an at sign are
a run. A run is cut at the seeds in it: each seed is a candidate, and so is each stretch of
whole words that no seed touches, where a word with an at sign stands alone. The contexts of a
candidate are the words around its run, so those of a list share the words around the list. Contexts (patterns) and candidates
(instances) form a graph. In every round a pattern's confidence in a kind is the smoothed
share of its different instances that belong to the kind, and an instance belongs to a kind
by the noisy-or of the patterns it is found in; seeds stay seeds. After the rounds, patterns
with enough support and confidence mark the other candidates in their place as kind
``context_<kind>``. Copies of a text add no support, as instances count once.

DataFrame expressions only. Texts are read in place; the graph holds only candidates, which
few texts have, aggregated per (pattern, instance) before anything is joined. What was
discovered meets the documents by (id, text hash); Spark broadcasts it only if its file is
below the session's threshold.

Expressions are anchored at the start of a run and do not give back what they took. Places come
from sums over blocks of matches, and a run finds its seeds by blocks too, so n matches in a text
cost about n ** 1.5 short steps and no copy of what came before.

Defined results: null and empty texts hold nothing. Ends are exclusive, places are code
points. Repeated rows get equal results. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.tables import stored
from terrace.llm.texts import SPACE, chunks_of, cut, each_index, let, running, words

KINDS = ("email", "ip", "card", "phone")
_MAIL = "A-Za-z0-9._%+-"
# The same leftmost matches as the plain expressions; lookbehind and possessive signs only avoid repeated work.
FORMS = {
    "email": rf"(?:\G|(?<![{_MAIL}]))[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",  # shorter runs are never cards
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_MARKED = r"[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
CANDIDATE = rf"(?<![^\x20\x09-\x0D]){_MARKED}(?:\x20{_MARKED})*+"
# Of a stretch: a word with an at sign, or other words as far as they go.
PIECE = r"[^\x20@]*+@[^\x20]*+|(?<![^\x20])[^\x20@]++(?![^\x20])(?:\x20[^\x20@]++(?![^\x20]))*+"
CUT = "array<struct<start:int,end:int,item:string,kinds:array<string>>>"
SPAN = "struct<start:int,rank:int,end:int,kind:string>"
SPANS = f"array<{SPAN}>"
_REACH = 64
ROUNDS = 3
LEAST_SUPPORT = 3
LEAST_CONFIDENCE = 0.8


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Every second digit from the right doubled, digit sums added, divisible by ten."""
    value = lambda d, i: d.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
    places = F.transform(F.split(F.reverse(digits), "(?<=.)(?=.)"), lambda d, i: value(d, i) - F.when(value(d, i) > 9, 9).otherwise(0))
    return F.aggregate(places, F.lit(0), lambda a, x: a + x) % 10 == 0


def accepted(kind: str, match: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(match, r"\."), lambda p: F.when(F.length(part(p)) > 3, False).otherwise(F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(F.length(_digits(match)).between(14, 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    return F.lit(True)


def _places(text: Column, form: str) -> Column:
    """(start, end, match, text before, text after) of every match, in order."""
    kind = "array<struct<start:int,end:int,match:string,before:string,after:string>>"

    def placed(m: Column, g: Column) -> Column:
        sizes = each_index(F.size(m), lambda i: F.length(F.get(g, i)) + F.length(F.get(m, i)), "array<int>")
        place = lambda start, i: F.struct(
            start.alias("start"),
            (start + F.length(F.get(m, i))).alias("end"),
            F.get(m, i).alias("match"),
            F.get(g, i).alias("before"),
            F.get(g, i + 1).alias("after"),
        )
        add = lambda a, x: a + x
        return let(running(sizes, add), lambda at: each_index(F.size(m), lambda i: place(F.get(at, i) + F.length(F.get(g, i)), i), kind))

    return let(
        F.regexp_extract_all(text, F.lit(form), F.lit(0)),
        lambda m: F.when(F.size(m) > 0, let(F.split(text, form), lambda g: placed(m, g))).otherwise(F.array().cast(kind)),
    )


def _spans_of(text: Column, rank: int, kind: str) -> Column:
    found = F.filter(_places(text, FORMS[kind]), lambda x: accepted(kind, x["match"]))
    spans = F.transform(
        found, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"))
    )
    wanted = text.contains("@") if kind == "email" else text.rlike("[0-9]")
    return F.when(wanted, spans.cast(SPANS)).otherwise(F.array().cast(SPANS))


def base_spans(text: Column) -> Column:
    """Spans of the fixed forms, by start and then kind."""
    found = F.concat(*[_spans_of(text, rank, kind) for rank, kind in enumerate(KINDS)])
    return F.when(text.rlike("[0-9@]"), F.sort_array(found)).otherwise(F.array().cast(SPANS))


def _bare(word: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(word, F.lit(""))), r"[^\p{L}]+", "")


def _with_hits(places: Column, seeds: Column) -> Column:
    """The places, each with the seeds that overlap it; looked up among the starts of blocks of seeds.

    Only phones and cards hold spaces, so only they reach into a run from before it; they have at most 19 digits
    and so fewer than ``_REACH`` seeds begin between their start and the run.
    """
    width = F.greatest(F.lit(1), F.floor(F.sqrt(F.size(seeds))).cast("int"))

    def looked_up(w: Column, firsts: Column) -> Column:
        def hits(x: Column) -> Column:
            low = F.greatest(F.lit(0), (F.size(F.filter(firsts, lambda f: f < x["start"])) - 1) * w - _REACH)
            high = F.size(F.filter(firsts, lambda f: f < x["end"])) * w
            return F.filter(F.slice(seeds, low + 1, F.greatest(F.lit(0), high - low)), lambda s: (s["start"] < x["end"]) & (s["end"] > x["start"]))

        return F.transform(places, lambda x: F.struct(*[x[n].alias(n) for n in ("start", "end", "match", "before", "after")], hits(x).alias("hits")))

    firsts = lambda w: F.transform(F.filter(seeds, lambda s, i: i % w == 0), lambda s: s["start"])
    return let(width, lambda w: let(firsts(w), lambda f: looked_up(w, f)))


def _cut(run: Column) -> Column:
    """(start, end, item, kinds) of the seeds in a run, and of the stretches that no seed touches."""
    match, first, h = run["match"], run["start"], run["hits"]

    def pieces(chunks: Column, reached: Column) -> Column:
        def stretch(i: Column) -> Column:
            """The pieces before seed i, or after the last."""
            begin = F.greatest(F.when(i < F.size(h), F.get(reached, i)).otherwise(F.coalesce(F.array_max(F.transform(h, lambda s: s["end"])), F.lit(0))) - first, F.lit(0))
            end = F.coalesce(F.get(h, i)["start"] - first, F.length(match))
            raw = cut(chunks, begin, F.greatest(end, begin))
            # A word that a seed touches goes with the seed.
            touched = F.when(i > 0, F.length(F.regexp_extract(raw, r"^[^\x20]*+", 0))).otherwise(0)
            kept = F.substring(raw, touched + 1, F.length(raw))
            kept = F.when(i < F.size(h), F.regexp_replace(kept, r"(?<![^\x20])[^\x20]++$", "")).otherwise(kept)
            at = first + begin + touched
            return F.transform(
                _places(kept, PIECE),
                lambda p: F.struct((at + p["start"]).alias("start"), (at + p["end"]).alias("end"), p["match"].alias("item"), F.array().cast("array<string>").alias("kinds")),
            ).cast(CUT)

        def seed(s: Column) -> Column:
            start, end = F.greatest(s["start"], first), F.least(s["end"], run["end"])
            return F.struct(start.alias("start"), end.alias("end"), cut(chunks, start - first, end - first).alias("item"), F.array(s["kind"]).alias("kinds"))

        return F.concat(F.transform(h, seed).cast(CUT), F.flatten(F.transform(F.sequence(F.lit(0), F.size(h)), stretch)))

    ends = running(F.transform(h, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    return let(chunks_of(match), lambda chunks: let(ends, lambda reached: pieces(chunks, reached)))


def candidates(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per candidate: document, place, instance, its two patterns, and its kind if it is a seed."""
    held = documents.where(F.col(text).rlike("[0-9@]")).select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(text).alias("content"),
        let(base_spans(F.col(text)), lambda seeds: let(_places(F.col(text), CANDIDATE), lambda places: _with_hits(places, seeds))).alias("places"),
    )
    runs = held.select("doc_id", "content", F.explode("places").alias("x"))
    before, after = words(F.col("x.before")), words(F.col("x.after"))
    left, far, right = _bare(F.try_element_at(before, F.lit(-1))), _bare(F.try_element_at(before, F.lit(-2))), _bare(F.get(after, F.lit(0)))
    patterns = F.array(F.concat_ws(" ", far, left, F.lit("_")), F.concat_ws(" ", left, F.lit("_"), right))
    one = runs.select("doc_id", "content", patterns.alias("patterns"), F.explode(_cut(F.col("x"))).alias("y"))
    return one.select("doc_id", "content", "y.start", "y.end", F.lower("y.item").alias("item"), "patterns", "y.kinds")


def score_patterns(found: DataFrame, rounds: int, support: int) -> DataFrame:
    """(pattern, kind, confidence, supporting instances) after the rounds."""
    edges = found.select(F.explode("patterns").alias("pattern"), "item").distinct()
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("size"))
    seeds = found.select("item", F.explode("kinds").alias("kind")).distinct().withColumn("belongs", F.lit(1.0))
    belongs, scored = seeds, None
    for turn in range(rounds):
        scored = (
            edges.join(belongs, "item")
            .groupBy("pattern", "kind")
            .agg(F.sum("belongs").alias("mass"))
            .where(F.col("mass") >= support)
            .join(sizes, "pattern")
            .select("pattern", "kind", "mass", (F.col("mass") / (F.col("size") + 1)).alias("confidence"))
        )
        if turn + 1 < rounds:
            scored = stored(scored, "pattern-scores")
            reached = edges.join(scored.where(F.col("confidence") >= 0.5), "pattern").groupBy("item", "kind")
            reached = reached.agg((1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("belongs"))
            belongs = reached.unionByName(seeds).groupBy("item", "kind").agg(F.max("belongs").alias("belongs"))
    return scored


def discovered_spans(
    documents: DataFrame,
    rounds: int = ROUNDS,
    least_support: int = LEAST_SUPPORT,
    least_confidence: float = LEAST_CONFIDENCE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, content, more): the spans that contexts add, per document and text hash."""
    found = stored(candidates(documents, doc_id, text), "candidates")
    trusted = score_patterns(found, rounds, least_support).where(F.col("confidence") >= least_confidence)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") + F.lit(len(KINDS) - 1)
    unseen = found.where(F.size("kinds") == 0).select("doc_id", "content", "start", "end", F.explode("patterns").alias("pattern"))
    spans = (
        unseen.join(trusted, "pattern")
        .groupBy("doc_id", "content", "start", "end")
        .agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
        .select("doc_id", "content", F.struct(F.col("start"), rank.alias("rank"), F.col("end"), F.concat(F.lit("context_"), F.col("kind")).alias("kind")).cast(SPAN).alias("span"))
    )
    return stored(spans.groupBy("doc_id", "content").agg(F.collect_set("span").alias("more")), "discovered-spans")


def find_personal_data(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The documents, all columns, with ``base_spans`` and ``all_spans``; input columns of these two names give way."""
    names = [c for c in documents.columns if c not in ("base_spans", "all_spans")]
    more = discovered_spans(documents, doc_id=doc_id, text=text, **settings)
    # The columns travel in one, so that no name of theirs meets one of ours.
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(doc_id).alias("_id"), F.xxhash64(text).alias("_content"))
    joined = held.join(more, F.col("_id").eqNullSafe(more["doc_id"]) & (F.col("_content") == more["content"]), "left")
    based = joined.withColumn("base_spans", base_spans(F.coalesce(F.col("_row").getField(text), F.lit(""))))
    every = F.sort_array(F.concat("base_spans", F.coalesce("more", F.array().cast(SPANS))))
    return based.select(*[F.col("_row").getField(c).alias(c) for c in names], "base_spans", every.alias("all_spans"))


def masked_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", **settings) -> DataFrame:
    """The documents, all columns, with every span replaced by its kind in brackets; ``n_chars``, if there, follows a changed text."""
    names = documents.columns
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in names if c != text]).alias("_row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = find_personal_data(held, **settings).withColumn("_masked", masked(F.col("text"), F.col("all_spans")))
    own = {c: F.col("_row").getField(c) for c in names if c != text}
    own[text] = F.col("_masked")
    if n_chars in own:
        own[n_chars] = F.when(F.size("all_spans") > 0, F.length("_masked").cast("long")).otherwise(own[n_chars])
    return found.select(*[own[c].alias(c) for c in names])


def shown(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, overlaps merged, replaced by its kind in brackets; null stays null."""

    def joined(chunks: Column, at: Column) -> Column:
        piece = lambda s, i: F.when(
            s["start"] >= F.get(at, i), F.concat(cut(chunks, F.get(at, i), s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        ).otherwise("")
        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(F.transform(spans, piece), ""), cut(chunks, last, F.length(text)))

    ends = running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    return F.when(F.size(spans) == 0, text).otherwise(let(chunks_of(text), lambda chunks: let(ends, lambda at: joined(chunks, at))))
