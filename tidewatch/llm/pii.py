"""Personal data and the terms that give it away (DataFrame functions only).

Base kinds are found by patterns, with places in code points. Then the corpus says which other terms
reveal a protected entity: a term that shares several different texts with an entity has
    PMI(term; entity) = log2 P(entity | term) / P(entity),
and it discloses the entity if that reaches a share of the entity's own information,
IC(entity) = -log2 P(entity), and the term hardly occurs without the entity. Such terms are spans
too, wherever they stand. ``sanitised`` replaces every span: by its kind (generalised) or by nothing.

Probabilities count distinct texts, so copies of a document are one observation. Terms are counted
outside the base spans, over whole texts. Counting shuffles only the words of texts with an entity that
is in enough texts and, for the few candidate terms, the texts that hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small_side, written
from .common import settled

# The base kinds in order and their patterns. The forms below accept what the plain ones
# accept, but start only where a run of their first class starts and never give characters back, so
# that long runs take linear time.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    # [0-9]([\x20-]?[0-9])+ that has 16 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text with such a span must contain; cheap to look for.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

TERM_KIND = "term"
#: Terms are whole runs of letters, marks and digits of any length.
TERM_CHARS = r"[\p{L}\p{M}\p{N}]"
#: A term discloses an entity if its PMI is at least this share of the entity's information,
DISCLOSURE = 0.9
#: if at least this share of the texts with the term have the entity,
CERTAINTY = 0.9
#: and if at least so many different texts show it.
SUPPORT = 3

#: Terms of texts are broadcast up to so many bytes, and joined by a shuffle beyond.
BROADCAST_BYTES = 16 << 20

SPAN = "struct<kind:string,start:int,end:int>"


def matches_in(text: Column, pattern: str | Column) -> Column:
    """An array of (start, end, match) of all leftmost non-overlapping matches, in code points."""
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.regexp_extract_all(text, regex, F.lit(0))
    # The pieces between the matches; there is one more of them, which arrays_zip pads with null.
    parts = F.arrays_zip(F.split(text, regex, -1).alias("gap"), found.alias("match"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string>>").alias("out"))

    def add(state: Column, part: Column) -> Column:
        begin = state["at"] + F.length(part["gap"])
        end = begin + F.length(part["match"])
        return F.when(part["match"].isNull(), state).otherwise(F.struct(
            end.alias("at"), F.concat(state["out"], F.array(F.struct(
                begin.alias("start"), end.alias("end"), part["match"].alias("match")))).alias("out")))

    return F.aggregate(parts, start, add, lambda s: s["out"])


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum over the digits, from the right, is a multiple of 10."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    # Splitting at "" gives one digit each; every second one counts double, less 9 above 9.
    weighed = F.transform(values, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)))
    total = F.aggregate(weighed, F.lit(0), lambda s, d: s + F.coalesce(d, F.lit(0)))
    return total % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3)
                        & (F.coalesce(p.try_cast("decimal(38,0)"), F.lit(999)) <= 255))
    if kind == "card":
        return F.length(_digits(match)).between(16, 19) & _luhn(_digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def _filtered(matches: Column, kind: str) -> Column:
    return F.filter(matches, lambda m: _valid(kind, m["match"]))


def base_spans(text: Column) -> dict[str, Column]:
    """Per kind the array of (start, end, match) of ``text`` (a plain column, not null)."""
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    out = {}
    for kind in KINDS:
        has = F.contains(text, F.lit(HINTS[kind])) if HINTS[kind] else text.rlike("[0-9]")
        out[kind] = F.when(has, _filtered(matches_in(text, PATTERNS[kind]), kind)).otherwise(none)
    return out


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, text_key (hash of the text), one array of spans per base kind, and ``row``: a struct
    whose field ``carried`` is a struct of the columns to carry along, whatever their names."""
    rows = docs.select(docs[id_col].alias("doc_id"),
                       F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
                       F.struct(F.struct(*[docs[c] for c in carry]).alias("carried") if carry
                                else F.lit(0).alias("carried")).alias("row"))
    rows = rows.withColumn("text_key", F.xxhash64("text"))
    return settled(rows.withColumns(base_spans(F.col("text"))))


def _parted() -> dict[str, Column]:
    """``outside``: the text with blanks for the characters of all base spans; ``inside``: with blanks for
    all others. Places stay as they are."""
    text = F.col("text")
    spans = F.array_sort(F.concat(*[F.transform(k, lambda m: F.struct(m["start"], m["end"])) for k in KINDS]))
    none = F.array().cast("array<string>")
    begin = F.struct(F.lit(0).alias("at"), none.alias("outside"), none.alias("inside"))

    def blanks(size: Column) -> Column:
        return F.rpad(F.lit(""), size, " ")

    def add(state: Column, s: Column) -> Column:
        start, end = F.greatest(state["at"], s["start"]), F.greatest(state["at"], s["end"])
        gap, size = start - state["at"], end - start
        return F.struct(
            end.alias("at"),
            F.concat(state["outside"], F.array(F.concat(
                F.substring(text, state["at"] + 1, gap), blanks(size)))).alias("outside"),
            F.concat(state["inside"], F.array(F.concat(
                blanks(gap), F.substring(text, start + 1, size)))).alias("inside"))

    done = F.aggregate(spans, begin, add)
    rest = F.substring(text, done["at"] + 1, F.length(text))
    some = F.size(spans) > 0
    return {"outside": F.when(some, F.concat(F.array_join(done["outside"], ""), rest)).otherwise(text),
            "inside": F.when(some, F.array_join(done["inside"], "")).otherwise("")}


def _words(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(TERM_CHARS + "++"), F.lit(0)))


def disclosing_terms(spans: DataFrame, disclosure: float = DISCLOSURE, certainty: float = CERTAINTY,
                     support: int = SUPPORT) -> DataFrame:
    """term, text_key: the terms that disclose some entity, with all texts that hold them.

    ``spans`` is what ``found_spans`` gives, for the whole corpus. Words inside base spans are no
    evidence, neither for nor against a term.
    """
    def entities_of(kind: str) -> Column:
        return F.transform(kind, lambda m: F.xxhash64(F.lit(kind), m["match"]))

    entities = written(spans.select("text_key", F.explode(F.concat(*map(entities_of, KINDS))).alias("entity"))
                       .distinct())
    # An entity in fewer texts cannot have a term's support.
    of_entity = written(entities.groupBy("entity").agg(F.count("*").alias("with_entity"))
                        .filter(F.col("with_entity") >= support))
    entities = written(entities.join(_few(of_entity), "entity"))
    most = of_entity.agg(F.max("with_entity")).first()[0] or 0
    parted = spans.withColumns(_parted())
    # All words of the texts with such an entity.
    near = written(parted.join(_few(entities.select("text_key").distinct()), "text_key", "left_semi")
                   .select("text_key", F.explode(_words(F.col("outside"))).alias("term")).distinct())
    # A term has at least as many texts as those with any entity: one that is in many of them cannot be
    # certain of a rarer entity. Common words end here, before they are paired and their texts looked up.
    possible = (F.col("near_any") >= support) & (F.col("with_entity") / F.col("near_any") >= certainty)
    anywhere = written(near.groupBy("term").agg(F.count("*").alias("near_any"))
                       .withColumn("with_entity", F.lit(most)).filter(possible).drop("with_entity"))
    seen = (near.join(_few(anywhere), "term").join(entities, "text_key").filter(possible)
            .groupBy("entity", "term", "with_entity", "near_any").agg(F.count("*").alias("both")))
    candidates = written(seen.filter((F.col("both") >= support) & (F.col("both") / F.col("near_any") >= certainty))
                         .drop("near_any"))
    # All texts with a candidate term, and whether it is outside the base spans there.
    holding = written(parted.select("text_key", F.inline(F.concat(
        F.transform(_words(F.col("outside")), lambda w: F.struct(w.alias("term"), F.lit(True).alias("free"))),
        F.transform(_words(F.col("inside")), lambda w: F.struct(w.alias("term"), F.lit(False).alias("free"))))))
        .join(_few(candidates.select("term").distinct()), "term", "left_semi")
        .groupBy("term", "text_key").agg(F.max("free").alias("free")))
    texts = spans.select("text_key").distinct().count()
    of_term = holding.filter("free").groupBy("term").agg(F.count("*").alias("with_term"))
    information = -F.log2(F.col("with_entity") / F.lit(max(1, texts)))
    given = F.col("both") / F.col("with_term")
    chosen = (candidates.join(of_term, "term")
              .filter((given >= certainty) & (information + F.log2(given) >= disclosure * information)
                      & (information > 0)).select("term").distinct())
    return holding.join(_few(chosen), "term", "left_semi").select("term", "text_key")


def _few(df: DataFrame) -> DataFrame:
    """``df`` for a join, broadcast only if it is proven small."""
    return F.broadcast(df) if small_side(df) else df


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  disclosure: float = DISCLOSURE, certainty: float = CERTAINTY,
                  support: int = SUPPORT, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row: doc_id, text, one array of (start, end, match) per base kind, ``term``, and
    ``row``, whose field ``carried`` is a struct of the columns to carry along.

    Places count code points from 0, ends are exclusive. A null text counts as empty. Spans of one kind
    do not overlap; spans of different kinds may. The edges of base spans end a term. Ids may repeat or be null.
    """
    spans = found_spans(docs, id_col, text_col, carry)
    pairs = written(disclosing_terms(spans, disclosure, certainty, support))
    terms = pairs.groupBy("text_key").agg(F.sort_array(F.collect_set("term")).alias("terms"))  # a text's own words
    size = pairs.agg(F.sum(F.octet_length("term").cast("bigint") + 32)).first()[0] or 0
    wide = spans.join(F.broadcast(terms) if size <= BROADCAST_BYTES else terms, "text_key", "left")
    # Terms are letters, marks and digits only, so they are safe inside a pattern.
    pattern = F.concat(F.lit(rf"(?<!{TERM_CHARS})(?:"), F.array_join("terms", "|"), F.lit(rf")(?!{TERM_CHARS})"))
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    of_terms = F.array_sort(F.concat(matches_in(F.col("outside"), pattern), matches_in(F.col("inside"), pattern)))
    parted = settled(wide.withColumns({
        name: F.when(F.col("terms").isNotNull(), text) for name, text in _parted().items()}))
    return settled(parted.select("doc_id", "text", "row", *KINDS, F.when(
        F.col("terms").isNotNull(), of_terms).otherwise(none).alias(TERM_KIND)))


def all_spans(kinds: list[str]) -> Column:
    """The spans of the given kinds in one array of (kind, start, end), by kind, then start."""
    def of_kind(kind: str) -> Column:
        return F.transform(kind, lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))

    return F.concat(*map(of_kind, kinds))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def sanitised_text(remove: bool = False) -> Column:
    """The text of ``personal_data`` with every span replaced by its kind, as ``[EMAIL]``, or removed.

    Overlapping spans are replaced once, by the kind of the one that starts first.
    """
    text = F.col("text")
    spans = F.array_sort(F.transform(all_spans([*KINDS, TERM_KIND]), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        mark = F.lit("") if remove else F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        piece = F.concat(F.substring(text, state["at"] + 1, s["start"] - state["at"]), mark)
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(
            fresh, F.concat(state["out"], F.array(piece))).otherwise(state["out"]).alias("out"))

    done = F.aggregate(spans, begin, add, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove: bool = False) -> DataFrame:
    """``docs`` with every span of ``personal_data`` replaced in its text; other columns, and null
    texts, stay as they are."""
    found = personal_data(docs, id_col, text_col, carry=tuple(docs.columns)).withColumn(
        "clean", sanitised_text(remove))
    carried = F.col("row")["carried"]
    return found.select(*[
        (F.when(carried[c].isNotNull(), F.col("clean")) if c == text_col else carried[c]).alias(c)
        for c in docs.columns])


def span_digest(found: DataFrame) -> DataFrame:
    """doc_id, counts per base kind, base_sha256 and spans of ``personal_data``'s rows."""
    return found.select(
        "doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(all_spans(KINDS)), 256).alias("base_sha256"),
        joined(all_spans([*KINDS, TERM_KIND])).alias("spans"))
