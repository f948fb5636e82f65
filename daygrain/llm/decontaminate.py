"""Benchmark decontamination by canonical templates, in DataFrame functions only.

Numbers, names and units become typed placeholders, so a question asked again with other values has
the same template. Windows of five template tokens are hash-joined with those of the benchmark; then
the values in the slots are compared: a copy has the same ones, a re-parameterised question has one
new value for each old one, and a chance likeness of templates maps one value to several.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrain.session import cut

WORDS = 5
PER_CENT = 80
# Scripts written without spaces, in which each character is a token (Thai, Lao, Myanmar, Khmer, kana, Han);
# what a token is (a word or a number); and the units that may follow a number. Letters come first in classes: most are among them.
UNSPACED = r"\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
NUMBER = r"[0-9]+(?:[.,:/][0-9]+)*%?"
TOKEN = rf"\x01?(?:[a-z[\p{{L}}\p{{M}}&&[^{UNSPACED}]]]++|[{UNSPACED}&&[\p{{L}}\p{{M}}]])|{NUMBER}"
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg lb pound pounds oz ounce ounces t ton tons "
    "ml l liter liters litre litres s sec second seconds min minute minutes h hour hours day days week weeks month months "
    "year years percent dollar dollars euro euros cent cents degrees mph"
).split()
#: A capital that follows a token without a sentence mark or line end between them begins a name; the character 1 is put before it.
NAME_AHEAD = rf"(?:(?<=[a-zA-Z0-9\p{{L}}\p{{M}}])([^a-zA-Z0-9.!?\n\p{{L}}\p{{M}}]++)|(?<=[0-9{UNSPACED}]))(?=[A-Z\p{{Lu}}\p{{Lt}}])"
#: What a token's code says beside its hash, and the template tokens of a name, a number and a unit.
IS_NAME, IS_NUMBER, IS_UNIT = 1, 2, 4
FORMS = ["majority", "caseless", "aligned"]


def _tokens(text: Column) -> Column:
    """Words, lower-cased and with the character 1 before a name, and numbers."""
    marked = F.regexp_replace(F.translate(text, "\x01", " "), F.lit(NAME_AHEAD), F.lit("$1\x01"))
    return F.regexp_extract_all(F.lower(marked), F.lit(TOKEN), F.lit(0))


def _code(token: Column, before: Column) -> Column:
    """The hash of a token in the upper 61 bits; whether it is a name, a number or the unit of one in the others."""
    code = lambda x, kind: F.shiftleft(F.xxhash64(x), 3).bitwiseOR(F.lit(kind).cast("bigint"))
    after_number = F.coalesce(before < ":", F.lit(False)) & F.coalesce(before > "/", F.lit(False))
    name = F.substr(token, F.lit(2))
    unit = lambda x: after_number & x.isin(*UNITS)
    return (
        F.when(token < "\x02", F.when(unit(name), code(name, IS_NAME | IS_UNIT)).otherwise(code(name, IS_NAME)))
        .when(token < ":", code(token, IS_NUMBER))
        .when(unit(token), code(token, IS_UNIT))
        .otherwise(code(token, 0))
    )


def _bits(code: Column, kind: int) -> Column:
    return code.bitwiseAND(F.lit(kind).cast("bigint"))


def _plain(code: Column) -> Column:
    """The template token in which a name is a word: a placeholder, or the word's hash with the other bits 0."""
    number, unit = F.lit(IS_NUMBER).cast("bigint"), F.lit(IS_UNIT).cast("bigint")
    return F.when(_bits(code, IS_NUMBER | IS_UNIT) == 0, _bits(code, -8)).when(_bits(code, IS_NUMBER) == 0, unit).otherwise(number)


def _hashed(texts: DataFrame, keys: tuple[str, ...], tokens: bool) -> DataFrame:
    """(keys, codes, kinds, plain, values): of each token the code, the template tokens and the hash; the token itself in ``found`` if asked for."""
    found = texts.select(*keys, _tokens(F.col("text")).alias("found"))
    # A row-making step keeps the optimizer from moving the expression of the tokens into each of its uses.
    found = found.select(*keys, F.explode(F.array("found")).alias("found")).where(F.size("found") > 0)
    kept = [F.transform("found", lambda x: F.ltrim(x, F.lit("\x01"))).alias("found")] if tokens else []
    coded = found.select(*keys, F.transform("found", lambda x, i: _code(x, F.get("found", i - 1))).alias("codes"), *kept)
    name = F.lit(IS_NAME).cast("bigint")
    return coded.select(
        "*",
        F.transform("codes", lambda c: F.when(_bits(c, IS_NAME) != 0, name).otherwise(_plain(c))).alias("kinds"),
        F.transform("codes", _plain).alias("plain"),
        F.transform("codes", lambda c: _bits(c, -8)).alias("values"),
    )


def _windows(coded: DataFrame, keys: tuple[str, ...], size: int, verbatim: bool, tokens: bool) -> DataFrame:
    """(keys, pos, window, typed, wordless): the hash of each window of ``size`` template tokens, with kinds and tokens if asked for.

    A window that holds a name has a second row, not ``typed``, in which names are words. A window without
    a word, or each one if ``verbatim``, goes by its values in place of its placeholders.

    The expressions of a window are short and have no lambda: in one large method they would not be compiled, and
    beside a lambda each row would carry copies of the whole arrays.
    """
    at = F.when(F.size("codes") >= size, F.sequence(F.lit(0), F.size("codes") - size))
    rows = coded.select(*keys, "kinds", "plain", "values", *(["found"] if tokens else []), F.explode(at).alias("pos"))
    part = lambda column: F.slice(column, F.col("pos") + 1, F.lit(size))
    word = lambda column: reduce(or_, [_bits(F.get(column, F.col("pos") + k), 7) == 0 for k in range(size)])
    by_value = F.xxhash64(F.lit(-size).cast("bigint"), part("values"))
    hashes = lambda column: F.when(word(column), F.xxhash64(part(column))).otherwise(by_value)
    if verbatim:
        one, two = by_value, F.lit(None).cast("bigint")
    else:
        one, two = hashes("kinds"), hashes("plain")
    more = [part("kinds").alias("k1"), part("plain").alias("k2"), part("found").alias("found")] if tokens else []
    rows = rows.select(*keys, "pos", (~word("kinds")).alias("wordless"), one.alias("one"), two.alias("two"), *more)
    second = F.when(F.col("two") != F.col("one"), F.col("two"))
    both = F.when(second.isNull(), F.array("one")).otherwise(F.array("one", "two"))
    rows = rows.select(*keys, "pos", "wordless", F.posexplode(both).alias("form", "window"), *[c for c in ("k1", "k2", "found") if tokens])
    typed = F.col("form") == 0
    kind = [F.when(typed, F.col("k1")).otherwise(F.col("k2")).alias("kinds"), "found"] if tokens else []
    return rows.select(*keys, "pos", "window", typed.alias("typed"), "wordless", *kind)


def template_windows(texts: DataFrame, *keys: str, tokens: bool = False, words: int = WORDS, short: tuple[int, ...] = ()) -> DataFrame:
    """The windows of ``words`` template tokens of each text, and by their values those of the sizes in ``short``."""
    coded = _hashed(texts, keys, tokens)
    return reduce(DataFrame.unionByName, [_windows(coded, keys, size, size != words, tokens) for size in (words, *short)])


def leaks(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, per_cent: int = PER_CENT) -> DataFrame:
    """One row for each document and benchmark item whose template windows it holds to ``per_cent`` at least.

    Columns: doc_id, item_id, n_windows of the item, n_found of them, n_slots (placeholders met),
    n_changed (those with another value than the item's; 0 for a plain copy) and form, which says the windows
    that were enough:

    * aligned: windows of the alignments that map every slot value of the item to one value of the document;
    * caseless: these, and windows without regard to letter case, in which only numbers and units are slots, if
      their slots have the item's values or those that most slots of the alignment give them;
    * majority: windows whose slots agree with what most slots of the alignment give them.

    The first form that is enough counts. A window without a word goes by its values; it counts only for an item
    that has no other. An item of fewer than ``words`` tokens is one window of its own length, by its values: it is
    found where it stands word for word, so that an item of one word is found wherever that word is. In scripts
    without spaces each character is a token. Tokens are compared by hashes of 61 bits, windows by 64.

    Null texts, texts without a token and rows without an id match nothing. Rows of one doc_id count as one
    document; rows of one item_id with different texts are variants, of which the best counts. Other columns are
    ignored. A document that repeats one window of an item again and again is compared at each place.
    """
    docs = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    items = benchmark.where("item_id IS NOT NULL").select("item_id", "text").distinct().withColumn("variant", F.xxhash64("text"))
    own = ("item_id", "variant")
    coded = cut(_hashed(items, own, True).withColumn("size", F.least(F.size("codes"), F.lit(words))))
    sizes = sorted(r["size"] for r in coded.select("size").distinct().collect())
    short = tuple(n for n in sizes if n < words)
    parts = [_windows(coded.where(F.col("size") == n), own, n, n < words, True).withColumn("size", F.lit(n)) for n in (words, *short)]
    every = cut(reduce(DataFrame.unionByName, parts))
    # Windows without a word count only where the item has no others.
    rich = every.where("typed AND NOT wordless").select(*own).distinct()
    spare = every.where("wordless AND size = " + str(words)).select(*own, "pos").distinct().join(rich, list(own))
    wanted = every.join(spare, [*own, "pos"], "left_anti")
    wanted = cut(wanted.drop("wordless", "size").withColumnsRenamed({"pos": "item_pos", "typed": "item_typed"}))
    total = wanted.where("item_typed").groupBy(*own).agg(F.count("*").alias("n_windows"))
    # The stored windows have a known size: the planner broadcasts them, or shuffles where they are many.
    small = cut(wanted.select("window").distinct())
    enough = F.col("n_found") * 100 >= F.col("n_windows") * per_cent
    pair = ["doc_id", "item_id", "variant"]
    # Each window of a document once, however often it stands there.
    met = cut(template_windows(docs, "doc_id", words=words, short=short).select("doc_id", "window").join(small, "window").distinct())
    places = met.join(wanted.select("window", *own, "item_pos"), "window")
    pairs = cut(places.groupBy(*pair).agg(F.count_distinct("item_pos").alias("n_found")).join(total, [*own]).where(enough).select(*pair))
    ids = cut(pairs.select("doc_id").distinct())
    again = template_windows(docs.join(ids, "doc_id", "left_semi"), "doc_id", tokens=True, words=words, short=short)
    again = again.withColumnRenamed("found", "said").drop("kinds", "wordless")
    aligned = again.join(wanted, "window").join(pairs, pair).withColumn("shift", F.col("pos") - F.col("item_pos"))
    slots = F.transform(
        "kinds", lambda k, i: F.struct((F.col("item_pos") + i).alias("at"), k.alias("kind"), F.col("found")[i].alias("asked"), F.col("said")[i].alias("given"))
    )
    slots = F.filter(slots, lambda s: s["kind"].isin(IS_NAME, IS_NUMBER, IS_UNIT))
    forms = (F.col("typed") & F.col("item_typed")).alias("typed"), (~F.exists("kinds", lambda k: k == IS_NAME)).alias("plain")
    aligned = cut(aligned.select(*pair, "shift", "item_pos", *forms, slots.alias("slots")))
    place = [*pair, "shift"]

    def agreeing(rows: DataFrame) -> DataFrame:
        """The rows of alignments that give no slot value two values."""
        values = rows.select(*place, F.explode("slots").alias("s"))
        clashes = values.groupBy(*place, "s.kind", "s.asked").agg(F.count_distinct("s.given").alias("n")).where("n > 1").select(*place).distinct()
        return rows.join(clashes, place, "left_anti").select(*pair, "item_pos", "slots")

    def near_majority(rows: DataFrame) -> DataFrame:
        """The rows whose slots all have the value that most slots of the alignment give the item's value."""
        values = rows.select(*place, "item_pos", F.explode("slots").alias("s")).select(*place, "item_pos", "s.*")
        slot = [*place, "kind", "asked"]
        votes = values.groupBy(*slot, "given").agg(F.count_distinct("at").alias("n"))
        usual = votes.groupBy(*slot).agg(F.max_by("given", F.struct("n", F.col("given") == F.col("asked"), "given")).alias("usual"))
        odd = values.join(usual, slot).where("given <> usual").select(*place, "item_pos").distinct()
        return rows.join(odd, [*place, "item_pos"], "left_anti").select(*pair, "item_pos", "slots")

    def counted(rows: DataFrame, rank: int) -> DataFrame:
        """The pairs of which enough positions are among the rows."""
        slot = rows.select(*pair, F.explode("slots").alias("s")).groupBy(*pair).agg(
            F.count_distinct("s.at").alias("n_slots"), F.count_distinct(F.when(F.col("s.asked") != F.col("s.given"), F.col("s.at"))).alias("n_changed")
        )
        found = rows.groupBy(*pair).agg(F.count_distinct("item_pos").alias("n_found")).join(total, ["item_id", "variant"]).where(enough)
        return found.join(slot, pair, "left").na.fill(0, ["n_slots", "n_changed"]).withColumn("rank", F.lit(rank))

    strict = cut(agreeing(aligned.where("typed")))
    plain = aligned.where("plain")
    same = plain.where(~F.exists("slots", lambda s: s["asked"] != s["given"])).select(*pair, "item_pos", "slots")
    either = cut(strict.union(near_majority(plain)).union(same))
    usual = cut(near_majority(aligned.where("typed")))
    done = counted(strict, 2).unionByName(counted(either, 1)).unionByName(counted(usual, 0))
    form = F.element_at(F.array(*map(F.lit, FORMS)), F.col("rank") + 1).alias("form")
    best = F.max_by(
        F.struct("n_windows", "n_found", "n_slots", "n_changed", form),
        F.struct("rank", F.col("n_found") / F.col("n_windows"), "variant"),
    )
    return done.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")
