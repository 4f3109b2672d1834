"""Operator 8: personal data found and sanitised, with the terms that would give it away.

Base spans come from patterns for e-mail addresses, IP addresses, card and phone numbers. Their values are the
protected entities. Corpus co-occurrence then tells how much a term reveals an entity: with p(e) the share of word
positions that hold entity e, and p(e|t) the share of occurrences of term t that stand within `reach` words of it, the
point-wise mutual information is log2(p(e|t) / p(e)), and its ratio to the entity's information content -log2 p(e) is
the share of the entity that the term discloses. Terms beyond `disclosed` become spans of kind `term` where p(e|t) is
also `certain` at its lower confidence limit (Wilson's, one term in 200 above it by chance at the `score` of 2.576).
Only different surroundings count as evidence for the limit, so copies of a passage make nothing certain: a term that
always stands beside one entity is certain from its second surroundings on. Sanitising generalises base spans to
their kind and removes such terms, or generalises them to a label where the caller names one.

Everything is DataFrame functions. Spark has no match positions, so they are sums of the lengths of what lies between
matches. The window around an entity bounds the pairs of entity and term by the number of words beside it; counts
have a map-side part, also for an entity or a term in a third of all rows.

Defined results: null or empty text has no spans; a row without doc_id gets base spans only; repeated rows are handled
each; an empty table gives no rows; other columns are kept by `sanitise` and ignored by `find`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, settle, words, workspace

KINDS = ("email", "ip", "card", "phone")
# The patterns, written so that Java's matcher works without recursion and in linear time: possessive repeats where
# nothing behind could take a character back, and a match starts a run of its characters or follows a match.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text with a match of the kind holds for certain.
MARKS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
SPAN = "struct<start:int,kind:int,stop:int>"
TERM = len(KINDS)  # the number of the kind `term`
MARKED = 1 << 18  # marks of words; as longs they are at most a few MB


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    def value(i: Column) -> Column:
        once = F.substring(number, F.length(number) - i + 1, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, once).otherwise(2 * once - F.when(once > 4, 9).otherwise(0))

    total = F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda s, i: s + value(i))
    return total % 10 == 0


def valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: let(
            F.regexp_replace(p, "^0+", ""), lambda q: (F.length(q) <= 3) & (F.coalesce(
                F.when(F.length(q) <= 3, q).try_cast("int"), F.lit(0)) <= 255)))
    if kind == "card":
        return let(digits(match), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))
    return F.length(digits(match)).between(10, 15)


def located(text: Column, pattern: Column) -> Column:
    """array<struct<start, stop, match>> of a pattern's matches, in code points."""
    return let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda found: let(
        F.split(text, pattern, -1), lambda between: F.aggregate(
            F.zip_with(found, F.slice(between, 1, F.size(found)), lambda m, b: F.struct(m.alias("m"), F.length(b).alias("b"))),
            F.expr("cast(struct(0, array()) as struct<at:int,out:array<struct<start:int,stop:int,match:string>>>)"),
            lambda s, x: F.struct(
                (s["at"] + x["b"] + F.length(x["m"])).alias("at"),
                F.concat(s["out"], F.array(F.struct((s["at"] + x["b"]).alias("start"),
                                                    (s["at"] + x["b"] + F.length(x["m"])).alias("stop"),
                                                    x["m"].alias("match")))).alias("out")),
            lambda s: s["out"])))


def spans_of(text: Column, kind: str) -> Column:
    """array<struct<start, kind, stop>> of one base kind."""
    mark = MARKS[kind]
    none = F.array().cast(f"array<{SPAN}>")
    some = F.contains(text, F.lit(mark)) if mark else text.rlike("[0-9][ -]?[0-9]")
    matches = F.filter(located(text, F.lit(PATTERNS[kind])), lambda x: valid(kind, x["match"]))
    spans = F.transform(matches, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
                                                    x["stop"].alias("stop")))
    return F.when(some, spans).otherwise(none)


def base_spans(text: Column) -> Column:
    """All base spans by start, then kind."""
    return F.array_sort(F.concat(*(spans_of(text, k) for k in KINDS)))


def spelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(F.array(*(F.lit(k) for k in (*KINDS, "term"))), s["kind"]), s["start"].cast("string"),
        s["stop"].cast("string"))), ",")


# ---- terms that give an entity away --------------------------------------------------------------------------------

LETTERS = r"\p{L}{4,}"  # a term: letters only, four at least


def term_of(word: Column) -> Column:
    """A word's letters, lower-cased; null where it has digits or inner marks, or fewer than four letters."""
    bare = F.lower(F.regexp_replace(word, r"^[^\p{L}\p{N}@]+|[^\p{L}\p{N}@]+$", ""))
    return F.when(bare.rlike(rf"^{LETTERS}$"), bare)


def entity_windows(docs: DataFrame, reach: int) -> DataFrame:
    """(entity, context, terms): each base span's value, a hash of the words around it, and the terms among them."""
    text = F.col("text")
    spanned = docs.select("text", base_spans(text).alias("spans")).filter(F.size("spans") > 0)
    # Around a span at most 64 characters a word are looked at, so a long text costs its spans and not its length.
    wide = reach * 64
    one = spanned.select("text", F.explode("spans").alias("s")).select(
        F.concat_ws(":", F.col("s.kind").cast("string"), F.lower(F.substring(
            "text", F.col("s.start") + 1, F.col("s.stop") - F.col("s.start")))).alias("entity"),
        F.substring("text", F.greatest(F.col("s.start") - wide, F.lit(0)) + 1,
                    F.least(F.col("s.start"), F.lit(wide))).alias("before"),
        F.substring("text", F.col("s.stop") + 1, F.lit(wide)).alias("after"))
    near = F.concat(F.slice(F.reverse(words(F.col("before"))), 1, reach), F.slice(words(F.col("after")), 1, reach))
    return one.select("entity", near.alias("near")).select(
        "entity", F.xxhash64("near").alias("context"), F.array_distinct(F.transform("near", term_of)).alias("terms"))


def wilson_limit(share: Column, trials: Column, score: float) -> Column:
    """Lower confidence limit of a probability that was met as `share` of so many trials."""
    z = score * score
    spread = score * F.sqrt((share * (1 - share) + z / (4 * trials)) / trials)
    return (share + z / (2 * trials) - spread) / (1 + z / trials)


def mark_of(word: Column) -> Column:
    """One of MARKED numbers, by the word's hash."""
    return F.pmod(F.xxhash64(word), F.lit(MARKED))


def telling_terms(docs: DataFrame, folder: str, reach: int = 8, disclosed: float = 0.9, certain: float = 0.2,
                  score: float = 2.576) -> DataFrame:
    """(doc_id, term) of every document that holds a term which discloses an entity."""
    # The limit is highest where a term stands beside its entity only, seen / (seen + score^2): pairs below
    # `certain` there can't reach it whatever else is counted, and go before anything is joined.
    reachable = F.col("seen") >= F.lit(certain) * (F.col("seen") + score * score)
    windows = settle(entity_windows(docs, reach), folder, "windows")
    entities = windows.groupBy("entity").agg(F.count("*").alias("n_e"))
    pairs = (windows.select("entity", "context", F.explode("terms").alias("term")).filter("term is not null")
             .groupBy("entity", "term", "context").agg(F.count("*").alias("n"))
             .groupBy("entity", "term").agg(F.sum("n").alias("n_et"), F.count("*").alias("seen"))
             .filter(reachable))
    pairs = settle(pairs.join(entities, "entity"), folder, "pairs")
    # Occurrences are summed per word before anything is joined; a common word is one row, whatever it stands in.
    said = docs.select("doc_id", F.explode(words(F.col("text"))).alias("word"))
    spoken = settle(said.groupBy("word").agg(F.count("*").alias("n")), folder, "words")
    total = spoken.agg(F.sum("n")).first()[0] or 0
    forms = spoken.withColumn("term", term_of(F.col("word"))).join(pairs.select("term").distinct(), "term")
    forms = settle(forms.select("word", "term", "n"), folder, "forms")
    often = forms.groupBy("term").agg(F.sum("n").alias("n_t"))
    content = -F.log2(F.col("n_e") / F.lit(float(max(total, 1))))
    odds = F.least(F.lit(1.0), F.col("n_et") / F.col("n_t"))
    share = 1 + F.log2(odds) / content
    sure = wilson_limit(odds, F.col("seen") / odds, score) >= certain
    telling = pairs.join(often, "term").filter((content > 0) & (share >= disclosed) & sure).select("term").distinct()
    known = settle(forms.join(telling, "term").select("word", "term"), folder, "known")
    # Words whose mark no telling word has go before any shuffle. The marks are few enough for every task at any size
    # of the corpus; words that share one by chance go in the join.
    marks = known.select(mark_of(F.col("word")).alias("mark")).distinct()
    likely = said.join(F.broadcast(marks), mark_of(F.col("word")) == F.col("mark"), "left_semi")
    return likely.join(known, "word").select("doc_id", "term").distinct()


def found(docs: DataFrame, reach: int, disclosed: float, certain: float) -> DataFrame:
    """doc_id, `row` with all columns of docs, `_base` and `_spans`: the base spans and all spans."""
    folder = workspace(docs.sparkSession)
    told = settle(telling_terms(docs, folder, reach, disclosed, certain), folder, "telling")
    patterns = told.filter("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.concat(
        F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(F.sort_array(F.collect_set("term")), "|"),
        F.lit(r")(?![\p{L}\p{N}])")).alias("_pattern"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    whole = docs.select("doc_id", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = whole.join(patterns, F.col("doc_id") == F.col("_id"), "left").withColumn("_base", base_spans(text))
    terms = F.transform(located(text, F.col("_pattern")), lambda x: F.struct(
        x["start"].alias("start"), F.lit(TERM).alias("kind"), x["stop"].alias("stop")))
    free = F.filter(terms, lambda t: ~F.exists("_base", lambda b: (b["start"] < t["stop"]) & (t["start"] < b["stop"])))
    return rows.withColumn("_spans", F.when(F.col("_pattern").isNull(), F.col("_base")).otherwise(
        F.array_sort(F.concat("_base", free)))).drop("_id", "_pattern")


def find(docs: DataFrame, reach: int = 8, disclosed: float = 0.9, certain: float = 0.2) -> DataFrame:
    """doc_id, the number of base spans of each kind, base_sha256, spans."""
    rows = found(docs.select("doc_id", "text"), reach, disclosed, certain)

    def count(kind: int) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(n).alias(f"n_{k}") for n, k in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(spelled(F.col("_base")), 256).alias("base_sha256"),
                       spelled(F.col("_spans")).alias("spans"))


def sanitise(docs: DataFrame, reach: int = 8, disclosed: float = 0.9, certain: float = 0.2,
             term_label: str = "") -> DataFrame:
    """The documents with base spans generalised to [EMAIL] and the like, and telling terms removed or, with a
    `term_label` such as "[TERM]", generalised to it."""
    rows = found(docs, reach, disclosed, certain).withColumn("text", F.col("row.text"))
    labels = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS), F.lit(term_label))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        # Of overlapping spans the later one adds only what it covers beyond the earlier, without a label of its own.
        return F.struct(
            F.greatest(s["at"], x["stop"]).alias("at"),
            F.when(x["start"] >= s["at"], F.concat(s["out"], F.array(
                F.substring("text", s["at"] + 1, x["start"] - s["at"]), F.get(labels, x["kind"])))).otherwise(s["out"])
            .alias("out"))

    clean = F.aggregate("_spans", start, step, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substring("text", s["at"] + 1, F.length("text"))))
    text = F.when(F.size("_spans") > 0, clean).otherwise(F.col("text"))
    return rows.select(F.col("row").withField("text", text).alias("row")).select("row.*")
