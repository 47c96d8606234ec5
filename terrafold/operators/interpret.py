"""Plain-language questions to filters, for a whole table of questions at once.

Words have named concepts (CONCEPTS), numbers have a value and a kind. A number is read by
what stands around it: which way it bounds, in what unit, and whose bound it can be (an
open permit, a roof, the year of building, the value). Flags are concepts in a row. Every
rule reads the whole question, so no rule depends on the order of the others; what the
rules that fired have read is left out of the free text.

Cities and property types are distinct values of the table, of any number: they are
joined to the questions by hash (of the first word, or of the first letters) and then
compared in full.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import sendable, sent, written

#: Words that carry no constraint.
IDLE_WORDS = (
    "been being was were had having does did doing done can could would should will shall may might must any some many much every each both who whom whose what when where why "
    "how there their them they this these those from into onto for but not only just also than then get got give tell want need please about across still yet very "
    "parcels parcel properties property homes home houses house show me find list all with an a the in on of and that which have has owned still are is years year old older "
    "than or over more roofs roof owners owner outside out state county worth market value built before after aged open roofing permit permits recorded sale no business account "
    "five absentee"
).split()

#: Concepts and the words for them; a word may have several.
CONCEPTS = {
    "roof": "roof roofs",
    "roofing": "roofing reroofing",
    "permit": "permit permits",
    "open": "open outstanding unclosed pending",
    "upward": "more over above past older longer least greater exceeding",
    "downward": "less under below most fewer",
    "aged": "aged ageing aging old older ancient failing",
    "years": "year years yr yrs",
    "none": "no never",
    "sale": "sale sales sold",
    "outside": "outside",
    "out": "out",
    "county": "county",
    "state": "state",
    "absentee": "absentee absentees",
    "business": "business tpp",
    "account": "account accounts",
    "worth": "worth value valued priced",
    "built": "built constructed",
    "earlier": "before prior earlier",
    "later": "after since later",
    "not": "not isn't aren't don't doesn't isnt arent dont doesnt non",
    "at": "in at",
    "other": "other rather",
    "than": "than",
    "apart": "apart away",
    "from": "from",
    "except": "excluding except besides",
    "holding": "with has having",
    "small": "a any of the recorded",
}
NUMERALS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten")
AGED_YEARS, LEAST_AMOUNT, DAYS = 15, 1000, 365
#: Pairs of concepts that exclude what follows, and concepts that do so alone.
EXCLUDING = (("not", "at"), ("other", "than"), ("apart", "from"))
FILTERS = [
    "city", "property_type", "min_open_permit_days", "min_roof_age", "has_open_roofing_permit", "has_permits", "owner_out_of_state", "owner_out_of_county",
    "no_recorded_sale", "has_business_account", "min_market_value", "max_market_value", "max_built_year", "min_built_year",
]


def plain(text: Column) -> Column:
    """Lower case, without ? ! , ; : and with single spaces; commas within numbers go."""
    whole = F.regexp_replace(F.translate(F.lower(text), "’", "'"), r"(?<=\d),(?=\d{3}(?!\d))", "")
    return F.trim(F.regexp_replace(F.translate(whole, "?!,;:", "     "), "\\s+", " "))


def _words(text: Column) -> Column:
    """Words, with hyphens between letters and a plus after a number as breaks; a k or m
    after a number belongs to it."""
    text = F.regexp_replace(F.regexp_replace(text, "(?<=[a-z])-(?=[a-z])", " "), r"(?<=\d)[+](?=\s|$)", " or more")
    return F.split(F.regexp_replace(text, r"(?<=\d) (?=[km](?:\s|$))", ""), " ")


def _marks(words: Column) -> Column:
    """The concepts of each word, as text between blanks."""
    of: dict[str, str] = {}
    for concept, line in CONCEPTS.items():
        for w in line.split():
            of[w] = of.get(w, " ") + concept + " "
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(of.items())])
    return F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), F.lit("")))


def _value(word: Column) -> Column:
    """A number of digits or by name, with k for thousands and m for millions; else null."""
    named = F.array_position(F.array(*[F.lit(n) for n in NUMERALS]), word)
    digits = F.regexp_extract(word, r"^\$?(\d[\d.]*?)([km]?)\.?$", 1).try_cast("double")
    unit = F.regexp_extract(word, r"^\$?\d[\d.]*?([km]?)\.?$", 1)
    return F.when(named > 0, named.cast("double")).otherwise(digits * F.when(unit == "m", 1e6).when(unit == "k", 1e3).otherwise(1.0))


def _is(at: Column, *concepts: str) -> Column:
    """Whether the word at a place (from 0) has one of the concepts; null outside is false."""
    mark = F.get(F.col("marks"), at)
    return F.coalesce(reduce(lambda a, b: a | b, [mark.contains(f" {c} ") for c in concepts]), F.lit(False))


def _last(upto: Column, reach: int, *concepts: str) -> Column:
    """The nearest place before ``upto``, at most ``reach`` words away, with a concept; -1 without."""
    found = F.lit(-1)
    for d in range(reach, 0, -1):
        found = F.when((upto >= d) & _is(upto - d, *concepts), upto - d).otherwise(found)
    return found


def _next(after: Column, reach: int, *concepts: str) -> Column:
    """The nearest place after ``after``, at most ``reach`` words away, with a concept; -1 without."""
    found = F.lit(-1)
    for d in range(reach, 0, -1):
        found = F.when(_is(after + d, *concepts), after + d).otherwise(found)
    return found


def _row(*steps: tuple[str, ...]) -> Column:
    """Whether words of the concepts stand in a row; small words between them do not count."""
    places = F.sequence(F.lit(0), F.size("marks") - 1)

    def follows(at: Column, left: list) -> Column:
        if not left:
            return F.lit(True)
        here = [_is(at + gap, *left[0]) & reduce(lambda a, b: a & b, [_is(at + g, "small") for g in range(gap)], F.lit(True)) & follows(at + gap + 1, left[1:]) for gap in range(3)]
        return reduce(lambda a, b: a | b, here)

    return F.exists(places, lambda at: _is(at, *steps[0]) & follows(at + 1, list(steps[1:])))


def _excludes() -> Column:
    """Whether the question excludes a place: outside of it, except, other than, not in it.
    Outside the county and outside the state are filters."""
    places = F.sequence(F.lit(0), F.size("marks") - 1)
    border = lambda at: reduce(lambda a, b: a | b, [_is(at + g, "county", "state") & reduce(lambda x, y: x & y, [_is(at + h, "small") for h in range(1, g)], F.lit(True)) for g in (1, 2, 3)])
    alone = F.exists(places, lambda at: _is(at, "except") | (_is(at, "outside") & ~border(at)))
    pair = F.exists(places, lambda at: reduce(lambda a, b: a | b, [_is(at, x) & _is(at + 1, y) for x, y in EXCLUDING]))
    return alone | pair


def _numbers() -> Column:
    """Each number with its bound: what it is a bound of (``of``), which way and its value.

    More than and the like stand up to three words before, or after it (20 or more, 20
    years or older). A bound in years is of an open permit if one is spoken of, else of the
    roof beside it; built before and after a year is of the building; an amount is of the value."""

    def read(x: Column) -> Column:
        at, v = x["at"], x["v"]
        up_before, down = _last(at, 3, "upward"), _last(at, 3, "downward")
        up_after = _next(at, 3, "upward", "aged")
        years = _is(at + 1, "years") | (_next(at, 3, "years") >= 0) & (up_after >= 0)
        built = _last(at, 3, "built")
        when = _last(at, 2, "earlier", "later")
        roof_before = _last(at, 7, "roof")
        barred = _last(at, 7, "worth", "built", "permit", "open", "sale")
        roof_after = _next(at, 5, "roof")
        opened = (_last(at, 9, "open") >= 0) | (_next(at, 8, "open") >= 0)
        small = v < LEAST_AMOUNT
        of = (
            F.when((built >= 0) & (when > built), F.when(_is(when, "earlier"), "built_before").otherwise("built_after"))
            .when(small & (up_before >= 0) & _is(at + 1, "years") & opened, "open")
            .when(small & (roof_before > barred) & ((up_before > roof_before) | (up_after >= 0)), "roof")
            .when(small & (roof_after >= 0) & years & (up_after >= 0) & (up_after < roof_after), "roof")
            .when(~small & (up_before >= 0) & (up_before > down), "least")
            .when(~small & (down >= 0), "most")
        )
        return F.struct(of.alias("of"), v.alias("v"), at.alias("at"))

    found = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("at"), _value(w).alias("v"))), lambda x: x["v"].isNotNull())
    return F.filter(F.transform(found, read), lambda x: x["of"].isNotNull())


def _bound(of: str) -> Column:
    """The value of the first number that bounds ``of``."""
    return F.get(F.filter("numbers", lambda x: x["of"] == of), 0)["v"]


def _best(df: DataFrame, vocabulary: DataFrame, keys: Column, key: Column, holds: Column, name: str) -> DataFrame:
    """The longest vocabulary entry that stands in the text, as ``name``: joined by
    hash on ``key`` (one of the text's ``keys``), then held to ``holds``."""
    asked = df.select("query_id", "text", F.explode(F.array_distinct(keys)).alias("key"))
    found = asked.join(sent(vocabulary.withColumn("key", key), sendable(vocabulary)), "key").where(holds)
    best = found.groupBy("query_id").agg(F.min(F.struct((-F.length("needle")).alias("size"), "entry", "needle")).alias("best"))
    df = df.join(sent(best, False), "query_id", "left").withColumn(name, F.col("best.entry"))
    # the entry's words are taken: one mark stands for them
    at = F.call_function("instr", F.col("text"), F.coalesce("best.needle", F.lit("\x02")))
    end = F.call_function("instr", F.concat(F.substr("text", at + F.length("best.needle")), F.lit(" ")), F.lit(" "))
    cut = F.concat(F.substr("text", F.lit(1), at - 1), F.lit("\x01"), F.substr("text", at + F.length("best.needle") + end - 1))
    return df.withColumn("text", F.when(at > 0, cut).otherwise(F.col("text"))).drop("best")


def interpret_questions(questions: DataFrame, cities: DataFrame, types: DataFrame) -> DataFrame:
    """(query_id, question) to typed filters, ``q``, ``declined`` and
    ``about_parcels``. ``cities`` and ``types`` have one column ``entry``.

    ``query_id`` is unique; a null question is empty. Questions that exclude a
    place are declined, with no filters."""
    city = written(cities.where("trim(entry) <> ''").select("entry", F.lower("entry").alias("needle")).distinct(), "cities")
    kind = written(types.where("trim(entry) <> ''").select("entry", F.lower(F.regexp_replace("entry", "([a-z])([A-Z])", "$1 $2")).alias("needle")).distinct(), "types")
    d = questions.select("query_id", "question", plain(F.coalesce("question", F.lit(""))).alias("text"))
    d = d.withColumn("words", _words(F.col("text"))).withColumn("marks", _marks(F.col("words")))
    d = written(d.withColumn("declined", _excludes()).drop("words", "marks"), "questions")
    d = d.withColumn("text", F.when(F.col("declined"), "").otherwise(F.col("text")))
    padded = F.concat(F.lit(" "), F.col("text"), F.lit(" "))
    d = _best(d, city, F.split("text", " "), F.substring_index("needle", " ", 1), padded.contains(F.concat(F.lit(" "), F.col("needle"), F.lit(" "))), "city")
    # types stand anywhere in the text: joined by their first letters, as many as the shortest has
    letters = kind.agg(F.least(F.lit(3), F.coalesce(F.min(F.length("needle")), F.lit(3)))).first()[0]
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length("text"), F.lit(1))), lambda i: F.substr("text", i, F.lit(letters)))
    d = _best(d, kind, grams, F.left("needle", F.lit(letters)), F.col("text").contains(F.col("needle")), "property_type")
    d = d.withColumn("words", _words(F.col("text"))).withColumn("marks", _marks(F.col("words")))
    d = written(d.withColumn("numbers", _numbers()), "questions")  # the rules are long expressions over a few columns: cut here and below

    flags = {
        "roofing": _row(("roofing",), ("permit",)), "open": _row(("open",)), "held": _row(("holding",), ("permit",)), "aged": _row(("aged",), ("roof",)),
        "state": _row(("out", "outside"), ("state",)), "county": _row(("out", "outside"), ("county",)), "absentee": _row(("absentee",)),
        "no_sale": _row(("none",), ("sale",)), "account": _row(("business",), ("account",)),
    }
    d = written(d.withColumns({f"is_{n}": c for n, c in flags.items()}), "questions")
    true = lambda c: F.when(c, True)
    roofing, stalled = F.col("is_roofing"), _bound("open").isNotNull()
    filters = {
        "min_open_permit_days": (_bound("open") * DAYS).cast("int"),
        "min_roof_age": F.coalesce(_bound("roof").cast("int"), F.when(F.col("is_aged"), AGED_YEARS)),
        "has_open_roofing_permit": true(roofing & (F.col("is_open") | stalled)),
        "has_permits": true((roofing & ~F.col("is_open") & ~stalled) | (~roofing & F.col("is_held"))),
        "owner_out_of_state": true(F.col("is_state")),
        "owner_out_of_county": true(F.col("is_county") | (F.col("is_absentee") & ~F.col("is_state"))),
        "no_recorded_sale": true(F.col("is_no_sale")),
        "has_business_account": true(F.col("is_account")),
        "min_market_value": _bound("least"), "max_market_value": _bound("most"),
        "max_built_year": (_bound("built_before") - 1).cast("int"), "min_built_year": (_bound("built_after") + 1).cast("int"),
    }
    d = d.withColumns(filters)
    # what a rule that fired has read is no free text
    read = {
        "min_open_permit_days": "open upward years", "min_roof_age": "roof upward aged years", "owner_out_of_state": "out outside state absentee", "owner_out_of_county": "out outside county absentee",
        "no_recorded_sale": "none sale", "has_business_account": "business account", "min_market_value": "worth upward", "max_market_value": "worth downward", "max_built_year": "built earlier", "min_built_year": "built later",
    }
    spent = F.flatten(F.array(*[F.when(F.col(n).isNotNull(), F.array(*[F.lit(c) for c in line.split()])).otherwise(F.array().cast("array<string>")) for n, line in read.items()]))
    d = written(d.withColumn("spent", F.array_distinct(spent)), "questions")
    idle = F.array(*[F.lit(w) for w in sorted(set(IDLE_WORDS) | set(NUMERALS))])
    used = lambda i: F.exists("spent", lambda c: F.get(F.col("marks"), i).contains(F.concat(F.lit(" "), c, F.lit(" ")))) | F.exists("numbers", lambda x: x["at"] == i)
    free = F.filter(F.transform("words", lambda w, i: F.when(~used(i), w)), lambda w: w.isNotNull())
    rest = F.array_join(F.filter(free, lambda w: (F.length(w) > 2) & ~F.array_contains(idle, w) & ~w.rlike(r"^[\d\x01]+$")), " ")
    d = d.withColumn("q", F.when(rest != "", rest))
    # a table, so that no filter over the result is pushed through the rules
    d = written(d.select("query_id", "question", "declined", *FILTERS, "q"), "questions")
    return d.withColumn("about_parcels", F.coalesce(*[F.col(n).cast("string") for n in FILTERS]).isNotNull())


def _held(p: str, f: str) -> Column:
    """Whether a parcel passes every filter that a question sets, but for city and type."""
    c = F.col

    def unset_or(name: str, test: Column) -> Column:
        return c(f"{f}.{name}").isNull() | test

    tests = [
        unset_or("min_open_permit_days", F.coalesce(f"{p}.longest_open_permit_days", F.lit(0)) >= c(f"{f}.min_open_permit_days")),
        unset_or("min_roof_age", c(f"{p}.roof_age_years") >= c(f"{f}.min_roof_age")),
        unset_or("has_open_roofing_permit", F.coalesce(f"{p}.open_roofing_permit_count", F.lit(0)) > 0),
        unset_or("has_permits", F.coalesce(f"{p}.has_permits", F.lit(False))),
        unset_or("owner_out_of_state", c(f"{p}.owner_out_of_state")),
        unset_or("owner_out_of_county", c(f"{p}.owner_out_of_county")),
        unset_or("no_recorded_sale", F.coalesce(f"{p}.no_recorded_sale_in_dor_window", F.lit(False))),
        unset_or("has_business_account", F.coalesce(f"{p}.business_account_count", F.lit(0)) > 0),
        unset_or("min_market_value", c(f"{p}.market_value") >= c(f"{f}.min_market_value")),
        unset_or("max_market_value", c(f"{p}.market_value") <= c(f"{f}.max_market_value")),
        unset_or("max_built_year", c(f"{p}.built_year") <= c(f"{f}.max_built_year")),
        unset_or("min_built_year", c(f"{p}.built_year") >= c(f"{f}.min_built_year")),
        unset_or("q", F.upper(F.concat_ws("\n", f"{p}.request_identifier", f"{p}.address_street", f"{p}.owner_name", f"{p}.owners_text")).contains(F.upper(f"{f}.q"))),
    ]
    return reduce(lambda a, b: a & b, tests)


def answer(interpreted: DataFrame, properties: DataFrame) -> DataFrame:
    """query_id, n, first_id: matching parcels of every question about parcels.

    Questions that set the same filters are answered once. What is asked is
    joined by hash on the equality filters it sets, city and type; only
    signatures with neither meet every parcel. A question without a matching
    parcel has no row.
    """
    keys = [*FILTERS, "q"]
    asked = interpreted.where("about_parcels")
    # a table: four joins read it, and the optimizer need not reason through the rules that made it
    signed = written(asked.select("query_id", *keys).withColumn("signature", F.xxhash64(F.to_json(F.struct(*keys)))), "asked")
    distinct = written(signed.select("signature", *keys).dropDuplicates(["signature"]), "signatures")
    few = sendable(distinct)
    wanted = ["request_identifier", "address_street", "owner_name", "owners_text", "roof_age_years", "longest_open_permit_days", "open_roofing_permit_count", "has_permits", "owner_out_of_state",
              "owner_out_of_county", "no_recorded_sale_in_dor_window", "business_account_count", "market_value", "built_year"]
    p = properties.select("property_id", F.upper("address_city").alias("city_key"), F.col("property_type").alias("type_key"), *wanted).alias("p")
    counted = []
    for city in (True, False):
        for kind in (True, False):
            f = distinct.where(F.col("city").isNotNull() == city).where(F.col("property_type").isNotNull() == kind).alias("f")
            on = [_held("p", "f")]
            if city:
                on.append(F.col("p.city_key") == F.upper("f.city"))
            if kind:
                on.append(F.col("p.type_key") == F.col("f.property_type"))
            met = p.join(sent(f, few, "merge" if city or kind else "shuffle_replicate_nl"), reduce(lambda a, b: a & b, on))
            counted.append(met.groupBy(F.col("f.signature").alias("signature")).agg(F.count(F.lit(1)).alias("n"), F.min("p.property_id").alias("first_id")))
    found = reduce(DataFrame.unionByName, counted)
    return signed.select("query_id", "signature").join(sent(found, few), "signature").select("query_id", "n", "first_id")
