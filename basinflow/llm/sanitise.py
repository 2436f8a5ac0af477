"""Personal data: spans, and terms that reveal them.

Four kinds are found in whole texts (``email``, ``ip``, ``card``, ``phone``).
Each distinct value is a protected entity.  From the corpus, the information
that a term gives about an entity is their pointwise mutual information

    log2( N * n(entity, term) / (n(entity) * n(term)) )

where N counts documents, n(entity, term) those with the term in a window of
code points beside the entity, and n(term) all documents that hold the term.
Divided by the entity's own information, log2(N / n(entity)), it is the share
of the entity that the term discloses.  In the windows of an entity, a term
that discloses at least REMOVE of it becomes a span of kind ``remove``, one of
at least GENERALISE a span of kind ``general``; a pair seen in fewer than
MIN_TEXTS different texts proves nothing (exact copies count as one text here).

Everything is DataFrame functions.  A text is split at the matches of a kind
once; places are running sums of lengths over the text's few pieces, taken in
a window over rows without text.  Counts are combined before every shuffle, so
an entity or term that a third of all rows hold stays spread.

Defined results: null text is empty and has no span; equal rows get equal
results, each on its own; places are code points, the end is exclusive; a null
id is kept; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basinflow.llm.store import cut

# The kinds, in the order that breaks ties, and their patterns.
# The email's and the address's runs may only begin where the last match ended
# or no run goes on, which finds the same spans without trying every character
# of a long run; possessive runs give the same spans, as what follows a run is
# never of its own characters.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "remove", "general"]
TOKENS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "remove": "", "general": "[TERM]"}

WINDOW = 64             # code points on either side of an entity
MIN_LETTERS = 3         # letters of a term
MIN_TEXTS = 2
GENERALISE, REMOVE = 0.6, 0.85
SMALL_ROWS = 100_000    # flagged pairs that may be broadcast
_LETTERS = r"\p{L}+"


def _luhn(digits: Column) -> Column:
    def place(x, i):
        twice = x.cast("int") * 2
        return F.when(i % 2 == 0, x.cast("int")).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    return F.aggregate(F.transform(F.reverse(F.split(digits, "")), place), F.lit(0), lambda s, x: s + x) % 10 == 0


def _passes(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        def small(part):
            bare = F.ltrim(part, F.lit("0"))
            return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))
        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _value(kind: str, match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "") if kind in ("card", "phone") else F.lower(match)


def matches(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per input row: rid, doc_id, text_hash and ``hits``, written once.

    A hit has its kind's rank, its number among the kind's matches, the code
    points since the last match and its own, its value, and what stands beside
    it.  All matches are listed, also those that fail their kind's test."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"),
                       F.xxhash64(text).alias("text_hash"), text.alias("text"))
    found = rows.select("*", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(k) for k, p in PATTERNS.items()])
    apart = found.select("*", *[F.when(F.size(k) > 0, F.split("text", p, -1)).alias(f"{k}_parts") for k, p in PATTERNS.items()])

    def hits(rank, kind):
        def hit(m, i):
            parts = F.col(f"{kind}_parts")
            return F.struct(
                F.lit(rank).alias("rank"), i.alias("pos"), F.char_length(parts[i]).alias("gap"), F.char_length(m).alias("length"),
                _passes(kind, m).alias("ok"), F.xxhash64(F.lit(kind), _value(kind, m)).alias("entity"),
                F.right(parts[i], F.lit(WINDOW + 1)).alias("before"), F.left(parts[i + 1], F.lit(WINDOW + 1)).alias("after"))
        return F.transform(kind, hit)
    listed = F.concat(*[hits(r, k) for r, k in enumerate(PATTERNS)])
    return cut(apart.select("rid", "doc_id", "text_hash", listed.alias("hits")), "matches")


def placed(found: DataFrame) -> DataFrame:
    """One row per match that passes: rid, text_hash, rank, start, end, entity,
    before, after.  Matches that fail only move the places of later ones."""
    each = found.select("rid", "text_hash", F.explode("hits").alias("h")).select("rid", "text_hash", "h.*")
    order = Window.partitionBy("rid", "rank").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum((F.col("gap") + F.col("length")).cast("long")).over(order)
    return (each.withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))
            .where("ok").drop("pos", "gap", "length", "ok"))


def _words(context: Column, first_cut: bool, origin: Column) -> Column:
    """(term, start, end) of the words of one side that lie wholly within the
    window; a word at the far edge of a longer text is left out."""
    long = F.char_length(context) > WINDOW
    words, gaps = F.regexp_extract_all(context, F.lit(_LETTERS), F.lit(0)), F.split(context, _LETTERS, -1)

    def add(at, x):
        last = F.when(F.size(at) > 0, F.element_at(at, -1)["end"]).otherwise(0)
        start = last + F.char_length(x["gap"])
        return F.concat(at, F.array(F.struct(x["word"].alias("word"), start.alias("start"),
                                             (start + F.char_length(x["word"])).alias("end"))))

    zipped = F.transform(words, lambda w, i: F.struct(w.alias("word"), gaps[i].alias("gap")))
    spans = F.aggregate(zipped, F.lit([]).cast("array<struct<word:string,start:int,end:int>>"), add)
    edge = (lambda s: s["start"] == 0) if first_cut else (lambda s: s["end"] == WINDOW + 1)
    spans = F.filter(spans, lambda s: ~(long & edge(s)) & (F.char_length(s["word"]) >= MIN_LETTERS))
    return F.transform(spans, lambda s: F.struct(F.lower(s["word"]).alias("term"), (origin + s["start"]).alias("start"),
                                                 (origin + s["end"]).alias("end")))


def beside(hits: DataFrame) -> DataFrame:
    """One row per word beside an entity: rid, text_hash, entity, term, start, end."""
    left = _words(F.col("before"), True, F.col("start") - F.char_length("before"))
    right = _words(F.col("after"), False, F.col("end"))
    return (hits.select("rid", "text_hash", "entity", F.explode(F.concat(left, right)).alias("w"))
            .select("rid", "text_hash", "entity", "w.*"))


def document_counts(docs: DataFrame, text_col="text") -> DataFrame:
    """(term, n): documents that hold the term, over the whole table."""
    words = F.split(F.coalesce(F.col(text_col), F.lit("")), r"[^\p{L}]+")
    terms = F.array_distinct(F.transform(F.filter(words, lambda w: F.char_length(w) >= MIN_LETTERS), lambda w: F.lower(w)))
    return docs.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def disclosures(docs: DataFrame, hits: DataFrame, words: DataFrame, n_docs: int, text_col="text",
                min_texts=MIN_TEXTS, generalise=GENERALISE) -> DataFrame:
    """(entity, term, share): how much of the entity the term discloses, for
    the pairs that reach ``generalise``; written once."""
    def documents(rows, keys):
        # Rows of one text meet first, then the texts of a key.
        per_text = rows.select(*keys, "text_hash", "rid").distinct().groupBy(*keys, "text_hash").agg(F.count(F.lit(1)).alias("n"))
        return per_text.groupBy(*keys).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))

    entities = documents(hits, ["entity"]).where(F.col("texts") >= min_texts).select("entity", F.col("n").alias("n_entity"))
    both = documents(words, ["entity", "term"]).where(F.col("texts") >= min_texts).select("entity", "term", F.col("n").alias("n_both"))
    pairs = both.join(entities, "entity").join(document_counts(docs, text_col).withColumnRenamed("n", "n_term"), "term")
    size = F.lit(float(n_docs))
    own = F.log2(size / F.col("n_entity"))
    mutual = F.log2(size * F.col("n_both") / (F.col("n_entity") * F.col("n_term")))
    share = F.when(own > 0, mutual / own).otherwise(F.lit(0.0))
    return cut(pairs.select("entity", "term", share.alias("share")).where(F.col("share") >= generalise), "disclosures")


def spans(docs: DataFrame, id_col="doc_id", text_col="text", generalise=GENERALISE, remove=REMOVE, min_texts=MIN_TEXTS) -> DataFrame:
    """One row per input row: doc_id, text_hash and ``spans`` (start, rank,
    kind, end, share), by start and rank."""
    found = matches(docs, id_col, text_col)
    hits = cut(placed(found), "hits")
    words = beside(hits)
    pairs = disclosures(docs, hits, words, found.count(), text_col, min_texts, generalise)
    if pairs.count() <= SMALL_ROWS:
        pairs = F.broadcast(pairs)
    told = words.join(pairs, ["entity", "term"]).groupBy("rid", "start", "end").agg(F.max("share").alias("share"))
    told = told.select("rid", F.when(F.col("share") >= remove, len(PATTERNS)).otherwise(len(PATTERNS) + 1).alias("rank"), "start", "end", "share")
    every = hits.select("rid", "rank", "start", "end", F.lit(None).cast("double").alias("share")).unionByName(told)
    # A term inside an entity of another kind is that entity's business.
    entity = F.col("rank") < len(PATTERNS)
    ahead = Window.partitionBy("rid").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy("rid").orderBy(F.desc("start"), F.desc("rank")).rowsBetween(Window.unboundedPreceding, 0)
    every = (every.withColumn("over", F.max(F.when(entity, F.col("end"))).over(ahead))
             .withColumn("next", F.min(F.when(entity, F.col("start"))).over(behind)))
    clear = (F.coalesce(F.col("over"), F.lit(0)) <= F.col("start")) & (F.coalesce(F.col("next"), F.col("end")) >= F.col("end"))
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("rank") + 1)
    per_row = (every.where(entity | clear).groupBy("rid")
               .agg(F.sort_array(F.collect_list(F.struct("start", "rank", kind.alias("kind"), "end", "share"))).alias("spans")))
    empty = F.lit([]).cast(per_row.schema["spans"].dataType)
    return (found.select("rid", "doc_id", "text_hash").join(per_row, "rid", "left")
            .select("doc_id", "text_hash", F.coalesce("spans", empty).alias("spans")))


def span_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitised(docs: DataFrame, id_col="doc_id", text_col="text", **thresholds) -> DataFrame:
    """``docs`` with every span replaced in the text: entities and generalised
    terms by the token of their kind, removed terms by nothing.  Overlapping
    spans become one.  Rows without a span are unchanged, a null text stays."""
    cols = docs.columns
    hurt = (spans(docs, id_col, text_col, **thresholds).where(F.size("spans") > 0).dropDuplicates(["doc_id", "text_hash"])
            .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("spans").alias("_spans")))
    keyed = docs.select(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(cols)])
    c = {name: f"c{k}" for k, name in enumerate(cols)}
    text = F.col(c[text_col])
    out = keyed.join(hurt, F.col(c[id_col]).eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("_hash")), "left")
    tokens = F.create_map(*[F.lit(x) for pair in TOKENS.items() for x in pair])

    def replace(done, s):
        start = F.greatest(s["start"], done["at"])
        grown = F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), (start - done["at"]).cast("int")), tokens[s["kind"]])
        return F.when(s["end"] <= done["at"], done).otherwise(F.struct(grown.alias("out"), s["end"].alias("at")))

    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    new = F.aggregate("_spans", begin, replace,
                      lambda d: F.concat(d["out"], F.substring(text, (d["at"] + 1).cast("int"), F.char_length(text))))
    out = out.withColumn(c[text_col], F.when(F.col("_spans").isNull(), text).otherwise(new))
    return out.select(*[F.col(f"c{k}").alias(name) for k, name in enumerate(cols)])
