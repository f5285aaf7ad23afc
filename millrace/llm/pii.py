"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

**Seeds.** Fixed patterns find emails, IP addresses, cards and phones; matches that fail their check are dropped. The
places come from splitting the text at the same pattern: lengths of pieces and matches add up to code points.
**Candidates.** Looser patterns find strings of the same shapes that the fixed ones leave out: an address without
a top domain or spelled with [at], dotted numbers beyond the range, card-like numbers that fail the check digit,
phone numbers without a plus. Each comes with its context: the whole word before and the whole word after. No pattern
and no context has a length limit.
**Bootstrapping.** Contexts and instances are a bipartite graph, kept for each kind and aggregated by Spark. A context scores
by the share of its instances that are believed, smoothed by its support; an instance by the best of its contexts, given
enough of them. ``ROUNDS`` times the scores go from seeds to contexts to instances and back. Candidates whose instance
scores ``ACCEPT`` or more in the last round are new spans. Seeds stay whatever the scores.

Null and empty texts have no spans. Repeated rows are judged each on its own. Columns besides id and text play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import Scratch

KINDS = ("email", "ip", "card", "phone")
ROUNDS, ACCEPT, SUPPORT, SMOOTH = 3, 0.8, 5, 1.0

# Fixed patterns. \G and the look-behind keep a search from starting again inside a run it has failed on; possessive
# counts do the same within a match. Neither changes what is found. In texts searched for emails the dots that join two
# labels have been replaced by JOINT, so one class does for domains of any length.
JOINT = "\u0001"
_LABEL = "[A-Za-z0-9-]"
_LOCAL = rf"[A-Za-z0-9._%+{JOINT}-]"
_DOMAIN = rf"[A-Za-z0-9{JOINT}-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++{JOINT}{_DOMAIN}++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# Separators between digits only; others have been replaced, so one class does for a run of any length.
CARD = r"[0-9][0-9 -]*+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
# A number is a whole run of digits and separators; what kind it may be is told by its digits.
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++(?:@| ?[\[(]at[\])] ?){_DOMAIN}++(?: ?[\[(]dot[\])] ?{_DOMAIN}++)*+",
    "number": r"(?<![0-9A-Za-z+])[0-9(][0-9() .-]{8,}+",
}


EMPTY = "array<struct<hit:string,start:int,end:int>>"


def matches(text: Column, pattern: str) -> Column:
    """Array of (hit, start, end): the matches of a pattern and their places."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    state = "struct<at:int,out:array<struct<hit:string,start:int,end:int>>>"
    walked = F.aggregate(
        F.arrays_zip(hits.alias("h"), F.slice(gaps, 1, F.size(hits)).alias("g")),
        F.lit(None).cast(state),
        lambda s, x: F.struct(
            (F.coalesce(s["at"], F.lit(0)) + F.length(x["g"]) + F.length(x["h"])).alias("at"),
            F.concat(
                F.coalesce(s["out"], F.array().cast(EMPTY)),
                F.array(
                    F.struct(
                        x["h"].alias("hit"),
                        (F.coalesce(s["at"], F.lit(0)) + F.length(x["g"])).alias("start"),
                        (F.coalesce(s["at"], F.lit(0)) + F.length(x["g"]) + F.length(x["h"])).alias("end"),
                    )
                ),
            ).alias("out"),
        ),
    )
    return F.coalesce(walked["out"], F.array().cast(EMPTY))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check digit."""
    n = F.length(digits)

    def weighed(i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        double = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((n - i) % 2 == 1, double).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda s, i: s + weighed(i)) % 10 == 0


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def number_of_digits(hit: Column) -> Column:
    return F.length(digits_of(hit))


def joined_labels(text: Column) -> Column:
    """The text with JOINT for dots between two characters of labels, and another character for what JOINT is in it."""
    free = F.regexp_replace(text, JOINT, "\u0002")
    return F.regexp_replace(free, rf"(?<={_LABEL})\.(?={_LABEL})", JOINT)


def email_matches(text: Column, pattern: str) -> Column:
    """Matches in a text with joined labels; the hits have their dots again."""
    found = matches(joined_labels(text), pattern)
    return F.transform(found, lambda x: F.struct(F.translate(x["hit"], JOINT, ".").alias("hit"), x["start"].alias("start"), x["end"].alias("end")))


def base(text: Column) -> dict[str, Column]:
    """The arrays of base matches by kind. Texts without a needed character are not searched."""
    none = F.array().cast(EMPTY)
    # One character for another, so places stay; only texts with a long enough number are rewritten.
    joined = F.regexp_replace(text, r"(?<![0-9])[ -]|[ -](?![0-9])", "\u0001")
    card = lambda x: F.length(x["hit"]) >= 13
    return {
        "email": F.when(F.contains(text, F.lit("@")), email_matches(text, EMAIL)).otherwise(none),
        "ip": F.when(
            F.rlike(text, F.lit(r"[0-9]\.[0-9]")),
            F.filter(matches(text, IP), lambda x: F.rlike(x["hit"], F.lit(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$"))),
        ).otherwise(none),
        "card": F.when(
            F.rlike(text, F.lit(r"[0-9](?:[ -]?[0-9]){12}")),
            F.filter(
                F.filter(matches(joined, CARD), lambda x: card(x) & number_of_digits(x["hit"]).between(13, 19)),
                lambda x: luhn(digits_of(x["hit"])),
            ),
        ).otherwise(none),
        "phone": F.when(
            F.contains(text, F.lit("+")),
            F.filter(matches(text, PHONE), lambda x: number_of_digits(x["hit"]).between(9, 15)),
        ).otherwise(none),
    }


def _named(kind: Column):
    return lambda x: F.struct(kind.alias("kind"), x["hit"].alias("hit"), x["start"].alias("start"), x["end"].alias("end"))


def _trimmed(hit: Column, start: Column) -> Column:
    own = F.regexp_replace(hit, "[^0-9]++$", "")
    return F.struct(own.alias("hit"), start.alias("start"), (start + F.length(own)).alias("end"))


def loose(text: Column) -> Column:
    """Candidates of all kinds; which kind a number may be is told by its digits and dots."""
    none = F.array().cast(EMPTY)
    emails = F.when(F.rlike(text, F.lit(r"@|[\[(]at[\])]")), email_matches(text, LOOSE["email"])).otherwise(none)
    runs = F.when(F.rlike(text, F.lit(r"[0-9(][0-9() .-]{7}")), matches(text, LOOSE["number"])).otherwise(none)
    # Separators at the end are no part of the number; a run that goes on with a letter is none.
    numbers = F.transform(
        F.filter(runs, lambda x: ~F.rlike(F.substring(text, x["end"], F.lit(2)), F.lit("^[0-9][A-Za-z]"))),
        lambda x: _trimmed(x["hit"], x["start"]),
    )

    def kind(x):
        n = number_of_digits(x["hit"])
        dotted = F.rlike(x["hit"], F.lit(r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"))
        return F.when(dotted, "ip").when(n.between(13, 19), "card").when(n.between(9, 12), "phone")

    return F.concat(
        F.transform(emails, _named(F.lit("email"))),
        F.filter(F.transform(numbers, lambda x: _named(kind(x))(x)), lambda x: x["kind"].isNotNull()),
    )


def mentions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row per document: id, the base spans, and all mentions with their contexts; base ones are marked."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    found = df.select("doc_id", "text", *[spans.alias(kind) for kind, spans in base(F.col("text")).items()], loose(F.col("text")).alias("loose"))
    named = [F.transform(kind, _named(F.lit(kind))) for kind in KINDS]
    found = found.select("doc_id", "text", F.concat(*named).alias("base"), "loose")
    added = F.filter("loose", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (b["end"] > x["start"])))

    # Places where a word can end; the word next to a mention is found in a short piece of the text, or else in all of it.
    spaces = "\t\n\u000b\u000c\r"
    plain = lambda c: F.translate(c, spaces, " " * len(spaces))

    def last_word(x):
        near = F.rtrim(plain(F.substring(F.col("text"), F.greatest(x["start"] - 39, F.lit(1)), F.least(x["start"], F.lit(40)))))
        whole = F.rtrim(plain(F.substring(F.col("text"), F.lit(1), x["start"])))
        return F.substring_index(F.when(F.contains(near, F.lit(" ")) | (x["start"] <= 40), near).otherwise(whole), " ", -1)

    def first_word(x):
        near = F.ltrim(plain(F.substring(F.col("text"), x["end"] + 1, F.lit(40))))
        whole = F.ltrim(plain(F.substring(F.col("text"), x["end"] + 1, F.length("text"))))
        return F.substring_index(F.when(F.contains(near, F.lit(" ")) | (x["end"] + 40 >= F.length("text")), near).otherwise(whole), " ", 1)

    def context(x, is_base):
        return F.struct(
            x["kind"].alias("kind"), F.lower(x["hit"]).alias("instance"), x["start"].alias("start"), x["end"].alias("end"),
            F.lit(is_base).alias("base"), F.lower(last_word(x)).alias("before"), F.lower(first_word(x)).alias("after"),
        )

    return found.select(
        "doc_id",
        F.concat(F.transform("base", lambda x: context(x, True)), F.transform(added, lambda x: context(x, False))).alias("mentions"),
    )


def believed(scratch: Scratch, flat: DataFrame) -> DataFrame:
    """(kind, instance) of candidates that the contexts of seeds vouch for."""
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(c).alias("word")) for s, c in (("<", "before"), (">", "after"))]))
    both = F.struct(F.lit("<>").alias("side"), F.concat_ws(" ", "before", "after").alias("word"))
    edges = flat.select("kind", "instance", "base", sides.alias("p")).unionByName(flat.select("kind", "instance", "base", both.alias("p")))
    edges = edges.where("p.word <> ''").select("kind", "instance", F.concat_ws(" ", "p.side", "p.word").alias("pattern"), "base")
    # One edge for each pattern and instance, whatever the number of mentions.
    edges = scratch.keep(edges.groupBy("kind", "pattern", "instance").agg(F.max("base").alias("base")))
    if edges.where("NOT base").isEmpty():
        return edges.where("NOT base").select("kind", "instance")
    # Patterns of candidates are scored; others cannot vouch for anything.
    useful = edges.where("NOT base").select("kind", "pattern").distinct()
    edges = scratch.keep(edges.join(useful, ["kind", "pattern"], "left_semi"))
    scores = edges.groupBy("kind", "instance").agg(F.max(F.col("base").cast("double")).alias("score"))
    scores = scratch.keep(scores.withColumn("base", F.col("score") == 1))
    for _ in range(ROUNDS):
        held = edges.drop("base").join(scores, ["kind", "instance"])
        patterns = held.groupBy("kind", "pattern").agg(F.sum("score").alias("hits"), F.count(F.lit(1)).alias("n"))
        sure = F.when(F.col("hits") >= SUPPORT, F.col("hits") / (F.col("n") + SMOOTH)).otherwise(0.0)
        patterns = patterns.select("kind", "pattern", sure.alias("sure"))
        new = edges.join(patterns, ["kind", "pattern"]).groupBy("kind", "instance").agg(F.max("sure").alias("new"))
        scores = scores.join(new, ["kind", "instance"], "left")
        scores = scores.select("kind", "instance", "base", F.when(F.col("base"), 1.0).otherwise(F.coalesce("new", F.lit(0.0))).alias("score"))
        scores = scratch.keep(scores)
    return scores.where((F.col("score") >= ACCEPT) & ~F.col("base")).select("kind", "instance")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: id and ``spans`` of (kind, start, end, base) by kind as listed, then start."""
    scratch = Scratch(docs.sparkSession)
    found = mentions(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    found = scratch.keep(found)
    flat = found.where("size(mentions) > 0").select("row", F.inline("mentions"))
    good = believed(scratch, flat).withColumn("good", F.lit(True))
    added = flat.where("NOT base").join(good, ["kind", "instance"], "left_semi")
    added = added.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end", F.col("base"))).alias("added"))
    own = F.transform(F.filter("mentions", lambda x: x["base"]), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["base"].alias("base")))
    order = F.map_from_arrays(F.array(*[F.lit(k) for k in KINDS]), F.array(*[F.lit(i) for i in range(4)]))
    spans = F.array_sort(
        F.transform(
            F.concat(own, F.coalesce("added", F.array().cast("array<struct<kind:string,start:int,end:int,base:boolean>>"))),
            lambda x: F.struct(order[x["kind"]].alias("k"), x["start"].alias("start"), x["end"].alias("end"), x["base"].alias("base"), x["kind"].alias("kind")),
        )
    )
    return found.join(added, "row", "left").select(F.col("doc_id").alias(id_col), spans.alias("spans"))


def _of_base(kind: str):
    return lambda s: s["base"] & (s["kind"] == kind)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    of_base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[F.size(F.filter("spans", _of_base(k))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(of_base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
