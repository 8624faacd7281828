"""PII (operator 2) by weak supervision; DataFrame and SQL functions only.

Fixed patterns find the base spans (email, ip, card, phone), which always stay. Wider patterns propose further candidates:
national ids, local phone numbers, titled names, secrets. Every candidate, base or not, gets a vote (for, against, none) from each
labeler: its strict shape (regex), a gazetteer of endings, prefixes and names, the words before it (context), the characters
around it, and its make-up. As votes are few, documents meet in a table of vote patterns with counts (3 to the number of
labelers rows at most). Expectation-maximisation over that table estimates how reliable each labeler is, with two classes
and votes independent within a class, and gives each pattern its probability. A final span classifier (naive Bayes over kind,
length, surroundings and the word before) is trained with these probabilities as soft labels over all candidates; a candidate
outside the base becomes a span where the classifier and the votes together find it at least as likely as ``least``, and where it
overlaps no base span.

Offsets count code points, end exclusive. Matches are leftmost and do not overlap within a kind; in the wider pattern they do not
overlap at all. Patterns are possessive, and start a run of letters once, so long texts cost linear time. Null text is empty and
has no spans; null or repeated ids are carried along, each row alone. With no candidates at all nothing is learnt and only base
spans (none) are returned. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import picked, stored

EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
#: 13 digits and more; shorter runs fail anyway, and a run's first digit is where its match begins.
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
WIDER = {
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20-][0-9]{3}-[0-9]{4}(?![0-9-])",
    "name": r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Sr|Sra)\.?\x20[A-Z][a-z]++(?:\x20[A-Z][a-z]++)?",
    "secret": r"\bAKIA[0-9A-Z]{16}\b|\b(?:password|passwd|token|secret|api_key)\x20?[=:]\x20?\x22?[A-Za-z0-9_-]{8,}+\x22?",
}
KINDS = [*BASE, *WIDER]
#: Gazetteers.
ENDINGS = ["com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "it", "uk", "eu"]
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
NAMES = ["Anna", "Ana", "Carlos", "David", "Emma", "Hans", "James", "Jean", "John", "Juan", "Laura", "Maria", "Marie", "Mary", "Michael", "Paul", "Peter", "Robert", "Sarah", "Thomas"]
CONTEXT = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": r"\bip\b|host|server|address|adresse|login",
    "card": "card|visa|credit|karte|carte|tarjeta|payment",
    "phone": "tel|phone|call|fax|mobil",
    "national_id": r"ssn|social|\bid\b|ident",
    "local_phone": "tel|phone|call|fax|mobil",
    "name": "name|dear|by|from|contact|signed",
    "secret": "key|secret|login|user|auth|access|credential",
}
LABELERS = ("shape", "gazetteer", "context", "edges", "make-up")
STEPS = 25
#: Code points of the pieces in which the characters around a span are looked up.
PIECE = 1024


def _hits(text: Column, pattern: str) -> Column:
    """Structs (start, end, found) of all matches: what stands between them gives the offsets."""
    return F.transform(
        F.arrays_zip(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"), F.split(text, pattern, -1).alias("gap")
        ),
        lambda x: F.struct(F.char_length(x["gap"]).alias("gap"), x["hit"].alias("hit")),
    )


def _sums(lengths: Column) -> Column:
    """What stands before each of the lengths, and at last the total.

    Arrays grow by copying, so sums run in pieces of about the square root of the number, then over the pieces.
    """
    piece = F.ceil(F.sqrt(F.size(lengths).cast("double"))).cast("int")

    def within(part: Column) -> Column:
        # Each entry's sum before it; the last is the total of the piece.
        return F.aggregate(part, F.array(F.lit(0)), lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)))

    def joined(parts: Column) -> Column:
        before = F.aggregate(parts, F.array(F.lit(0)), lambda done, p: F.concat(done, F.array(F.element_at(done, -1) + F.element_at(p, -1))))
        # One evaluation of the sums over pieces serves all of them.
        return F.flatten(
            F.transform(
                F.array(before),
                lambda at: F.concat(
                    F.flatten(F.transform(parts, lambda p, k: F.transform(F.slice(p, 1, F.size(p) - 1), lambda x: x + F.get(at, k)))),
                    F.array(F.element_at(at, -1)),
                ),
            )
        )

    def of(all_: Column, size: Column) -> Column:
        pieces = F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / size).cast("int")), lambda k: within(F.slice(all_, k * size + 1, size)))
        return F.flatten(F.transform(F.array(pieces), joined))

    bound = F.flatten(F.transform(F.array(F.struct(lengths.alias("all"), piece.alias("size"))), lambda v: of(v["all"], v["size"])))
    return F.when(F.size(lengths) > 0, bound).otherwise(F.array(F.lit(0)))


def _offsets(hits: Column) -> Column:
    """From the gaps and matches to (start, end, hit); the last entry, the gap behind the last match, goes."""
    found = F.filter(hits, lambda x: x["hit"].isNotNull())

    def of(v: Column) -> Column:
        def span(x: Column, k: Column) -> Column:
            start = F.get(v["sums"], k) + x["gap"]
            return F.struct(start.alias("start"), (start + F.char_length(x["hit"])).alias("end"), x["hit"].alias("hit"))

        return F.transform(v["found"], span)

    sums = _sums(F.transform(found, lambda x: x["gap"] + F.char_length(x["hit"])))
    return F.flatten(F.transform(F.array(F.struct(found.alias("found"), sums.alias("sums"))), of))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    digits = F.reverse(_digits(hit))
    each = F.transform(F.split(digits, ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    size = F.char_length(_digits(hit))
    if kind == "ip":
        return ~hit.rlike(r"(?:^|\.)0*(?:[1-9][0-9]{3,}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])(?:\.|$)")
    if kind == "card":
        return size.between(13, 19) & _luhn(hit)
    if kind == "phone":
        return size.between(9, 15)
    return F.lit(True)


def _may_hold(text: Column, kind: str) -> Column:
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike("[0-9]")


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "+").when(no, "-").otherwise("0")


def _by_kind(kind: Column, of: dict[str, Column]) -> Column:
    out = F.lit(False)
    for name, value in of.items():
        out = F.when(kind == name, value).otherwise(out)
    return out


def _place(of: str, letter: Column) -> Column:
    return F.position(letter, F.lit(of))


def _votes(kind: Column, hit: Column, before: Column, left: Column, right: Column) -> Column:
    strict = {
        "email": hit.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"),
        "ip": hit.rlike(r"^(?:[1-9][0-9]?|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.(?:0|[1-9][0-9]{0,2})){3}$"),
        "card": hit.rlike(r"^(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7})$"),
        "phone": hit.rlike(r"^\+[0-9]{1,3}[ .-]?\(?[0-9]"),
        "national_id": hit.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"),
        "local_phone": hit.rlike(r"^\(?[2-9][0-9]{2}\)?[ -][2-9]"),
        "name": hit.rlike(r" [A-Z][a-z]+ [A-Z][a-z]+$"),
        "secret": hit.rlike(r"^AKIA[0-9A-Z]{16}$|[0-9a-f]{16,}\x22?$"),
    }
    listed = {
        "email": F.lower(F.substring_index(hit, ".", -1)).isin(ENDINGS),
        "ip": ~hit.rlike(r"^(?:0|127|255)\."),
        "card": _digits(hit).rlike(ISSUERS),
        "phone": _digits(hit).rlike("^(?:1|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1-6]|9[0-58])"),
        "national_id": F.lit(False),
        "local_phone": F.lit(False),
        "name": F.exists(F.split(hit, " "), lambda w: w.isin(NAMES)),
        "secret": hit.rlike("^(?:AKIA|password|token)"),
    }
    context = _by_kind(kind, {k: F.lower(before).rlike(p) for k, p in CONTEXT.items()})
    joined = left.rlike("[A-Za-z0-9_/=]$") | right.rlike("^[A-Za-z0-9_/=]")
    letters = F.char_length(F.regexp_replace(hit, "[^A-Za-z]", "")) / F.char_length(hit)
    varied = F.size(F.array_distinct(F.split(hit, ""))) >= 5
    return F.concat(
        _vote(_by_kind(kind, strict), ~_by_kind(kind, strict)),
        _vote(_by_kind(kind, listed), F.lit(False)),
        _vote(context, F.lower(before).rlike(r"version|chapter|page|isbn|order")),
        _vote(left.rlike(r"(?:^|[ \n\t(<:,\x22])$") & right.rlike(r"^(?:$|[ \n\t)>.,;:\x22])"), joined),
        _vote(varied & ((letters < 0.1) | kind.isin("email", "name", "secret")), ~varied),
    )


def _features(kind: Column, hit: Column, before: Column, left: Column, right: Column) -> Column:
    """Values of a bounded set: kind, length, characters around, and one of 64 hashes of the word before."""
    shape = F.translate(F.concat(F.right(left, F.lit(1)), F.lit("~"), F.left(right, F.lit(1))), "\n\t", "  ")
    kinds = F.regexp_replace(F.regexp_replace(shape, "[A-Za-z]", "a"), "[0-9]", "9")
    around = F.when(kinds.rlike(r"^[a9 .,:;()\x22=/<>]?~[a9 .,:;()\x22=/<>]?$"), kinds).otherwise("other")
    word = F.lower(F.regexp_extract(before, r"([A-Za-z]+)[^A-Za-z]*$", 1))
    return F.array(
        F.concat(F.lit("kind "), kind),
        F.concat(F.lit("length "), kind, F.lit(" "), F.least(F.floor(F.char_length(hit) / 4), F.lit(15)).cast("string")),
        F.concat(F.lit("around "), around),
        F.concat(F.lit("before "), F.pmod(F.xxhash64(word), F.lit(64)).cast("string")),
    )


def candidates(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) to (doc_id, base, more): arrays of (kind, start, end, votes, features)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    empty = F.expr("cast(array() as array<struct<gap: int, hit: string>>)")
    found = rows.withColumns({f"hits_{k}": F.when(_may_hold(F.col("text"), k), _hits(F.col("text"), p)).otherwise(empty) for k, p in BASE.items()})
    wide = "|".join(f"(?:{p})" for p in WIDER.values())
    may = F.col("text").rlike(r"[0-9]{3}-|\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Sr|Sra)\b|AKIA|password|passwd|token|secret|api_key")
    found = found.withColumn("hits_more", F.when(may, _hits(F.col("text"), wide)).otherwise(empty))
    hit_somewhere = F.greatest(*(F.size(f"hits_{k}") for k in [*BASE, "more"])) > 0
    pieces = F.when(hit_somewhere, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))
    spans = found.select("doc_id", pieces.alias("pieces"), *(_offsets(F.col(f"hits_{k}")).alias(k) for k in [*BASE, "more"]))

    def cut(start: Column, size: Column) -> Column:
        """``size`` code points (40 at most) from ``start`` on; places in a long text are only found from its begin, those in a piece at once."""
        at = F.floor(start / PIECE).cast("int")
        two = F.concat(F.coalesce(F.get("pieces", at), F.lit("")), F.coalesce(F.get("pieces", at + 1), F.lit("")))
        return F.substring(two, start - at * PIECE + 1, size)

    def placed(x: Column) -> Column:
        return x.withField("before", cut(F.greatest(x["start"] - 40, F.lit(0)), F.least(x["start"], F.lit(40)))).withField("right", cut(x["end"], F.lit(1)))

    def described(x: Column, kind: Column) -> Column:
        before, left, right = x["before"], F.right(x["before"], F.lit(1)), x["right"]
        return F.struct(
            kind.alias("kind"),
            x["start"].alias("start"),
            x["end"].alias("end"),
            _votes(kind, x["hit"], before, left, right).alias("votes"),
            _features(kind, x["hit"], before, left, right).alias("features"),
        )

    def of_kind(k: str) -> Column:
        return F.transform(F.transform(F.filter(F.col(k), lambda x: _valid(k, x["hit"])), placed), lambda x: described(x, F.lit(k)))

    def wider_kind(hit: Column) -> Column:
        named = hit.rlike(r"^(?:Mr|Mrs|Ms|Dr|Herr|Frau|Mme|Sr|Sra)\.? ")
        numbers = F.when(hit.rlike(r"^[0-9]{3}-[0-9]{2}-"), "national_id").when(hit.rlike(r"^\(?[0-9]"), "local_phone")
        return numbers.when(named, "name").otherwise("secret")

    more = F.transform(F.transform("more", placed), lambda x: described(x, wider_kind(x["hit"])))
    return spans.select("doc_id", F.concat(*map(of_kind, BASE)).alias("base"), more.alias("more"))


def reliabilities(patterns: DataFrame) -> DataFrame:
    """Rows (votes, n) to one row: ``prior`` and, per labeler, class and vote, ``odds``: log probability for over against.

    Expectation-maximisation inside one expression, over at most 3 ** len(LABELERS) patterns.
    """
    table = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("patterns"))
    rows = F.col("patterns")

    def vote(p: Column, k: int) -> Column:
        return _place("+0-", F.substring(p["votes"], k + 1, 1)) - 1

    def posterior(p: Column, state: Column) -> Column:
        logit = state["prior"]
        for k in range(len(LABELERS)):
            logit = logit + F.element_at(state["odds"], (vote(p, k) + 3 * k + 1).cast("int"))
        return 1 / (1 + F.exp(-logit))

    def step(state: Column, _: Column) -> Column:
        yes = F.transform(rows, lambda p: F.struct(p["votes"].alias("votes"), (p["n"] * posterior(p, state)).alias("y"), (p["n"] * (1 - posterior(p, state))).alias("x")))

        def total(field: str, k: int | None = None, outcome: int | None = None) -> Column:
            one = F.lit(0.0)
            if k is None:
                return F.aggregate(yes, one, lambda a, p: a + p[field])
            return F.aggregate(yes, one, lambda a, p: a + F.when(vote(p, k) == outcome, p[field]).otherwise(0.0))

        y, x = total("y"), total("x")
        odds = [F.ln((total("y", k, o) + 0.5) / (y + 1.5)) - F.ln((total("x", k, o) + 0.5) / (x + 1.5)) for k in range(len(LABELERS)) for o in range(3)]
        return F.struct(F.ln((y + 0.5) / (x + 0.5)).alias("prior"), F.array(*odds).alias("odds"))

    # Votes for are taken as better evidence than votes against to begin with, which tells the two classes apart.
    start = F.struct(F.lit(0.0).alias("prior"), F.array(*(F.lit(v) for _ in LABELERS for v in (1.0, 0.0, -1.0))).alias("odds"))
    return table.select(F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step).alias("m")).select("m.prior", "m.odds")


def pii(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_more, n_spans (all of them)."""
    work = stored(candidates(picked(docs, doc_id=id_col, text=text_col)), "pii-candidates")
    each = work.select(F.explode(F.concat("base", "more")).alias("c")).select("c.votes", "c.features")
    patterns = stored(each.groupBy("votes").agg(F.count(F.lit(1)).alias("n")), "pii-patterns")
    learnt = reliabilities(patterns).first()

    def logit(votes: Column) -> Column:
        out = F.lit(float(learnt["prior"]))
        for k in range(len(LABELERS)):
            at = _place("+0-", F.substring(votes, k + 1, 1)) + 3 * k
            out = out + F.element_at(F.array(*(F.lit(float(v)) for v in learnt["odds"])), at.cast("int"))
        return out

    soft = patterns.select("votes", "n", (1 / (1 + F.exp(-logit(F.col("votes"))))).alias("p"))
    # The classifier's counts: votes and features meet in a bounded table before anything is joined.
    counted = each.select("votes", F.explode("features").alias("feature")).groupBy("votes", "feature").agg(F.count(F.lit(1)).alias("n"))
    joined = counted.join(soft.select("votes", "p"), "votes")
    both = joined.groupBy("feature").agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no"))
    sums = soft.agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no")).first()
    yes, no = sums["yes"] or 0.0, sums["no"] or 0.0
    weight = F.ln((F.col("yes") + 1) / (yes + 2)) - F.ln((F.col("no") + 1) / (no + 2))
    weights = both.agg(F.map_from_entries(F.collect_list(F.struct("feature", weight.alias("w")))).alias("weights")).first()["weights"] or {}
    table = F.create_map(*(F.lit(x) for pair in sorted(weights.items()) for x in pair)) if weights else F.expr("cast(map() as map<string, double>)")

    def chance(x: Column) -> Column:
        """The mean of what the votes and the classifier say, in log odds."""
        own = F.aggregate(x["features"], F.lit(float(learnt["prior"])), lambda a, f: a + F.coalesce(F.element_at(table, f), F.lit(0.0)))
        return 1 / (1 + F.exp(-(own + logit(x["votes"])) / 2))

    def clear(x: Column) -> Column:
        return ~F.exists("base", lambda b: (x["start"] < b["end"]) & (b["start"] < x["end"]))

    more = F.filter("more", lambda x: clear(x) & (chance(x) >= least))
    rows = work.select("doc_id", "base", more.alias("more"))

    def text(kinds: list[str]) -> Column:
        parts = F.filter(F.concat("base", "more"), lambda x: x["kind"].isin(kinds))
        ordered = F.array_sort(F.transform(parts, lambda x: F.struct(F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).alias("nth"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
        return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return rows.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in BASE),
        F.sha2(text([*BASE]).cast("binary"), 256).alias("base_sha256"),
        text(KINDS).alias("spans"),
        F.size("more").cast("long").alias("n_more"),
        (F.size("base") + F.size("more")).cast("long").alias("n_spans"),
    )
