"""Line dedup by a deletion-neighbourhood join (native DataFrame operations only).

Two lines repeat each other if their word sequences are equal, or differ by few
words put in, left out or replaced: one, or from ``LONG`` words on, a tenth of the
shorter line's. A line goes if an earlier line repeats it. Equal lines meet by
hash. Short lines emit the sequences that remain when one of their words is left
out, as hashed keys; lines within one edit share a key, so a minimum per key finds
the earliest, and no pair within a key is ever formed.

Long lines emit runs of ``RUN`` words. An edit touches that many of them at most,
so of the runs in any fixed order, two lines within k edits share ``SHARED`` of
their first RUN * k + SHARED. Runs that a sample finds often come last, so a
passage that many lines hold gives keys only to lines that are little else. Lines
are first held against the earliest of each key; only those that find no repeat
there are held against all earlier lines of their keys. Two lines that share a key
become a pair only if the parities of their words are as near as k edits leave
them, so lines that have little more than a passage in common form none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_BYTES, column_like, row_key, smallest_hashes
from tidemark.session import discard, materialised

_SPACES = " \t\n\x0b\x0c\r"
#: Bits of one word's share in a variant's hash: sums of 2**22 words fit a long.
_SHARE = (1 << 40) - 1
#: What a key stands for: a line with one word replaced, one word less, or as it is.
REPLACED, SHORTENED, WHOLE = range(3)
#: Words from which a line may differ by a tenth of them.
LONG = 40
#: Words of a run, and how many first runs two near lines share.
RUN, SHARED = 4, 3
#: Classes that runs are counted in, and lines of the sample.
CLASSES, SAMPLE_LINES = 1 << 16, 2000
#: Shares of the runs that are shuffled one after the other: bounds what lies on disk.
#: There are fewer if a share would have less than so many runs.
SHARES, SHARE_KEYS = 8, 2_000_000
#: What a document's line numbers take in a broadcast beside themselves.
ROW_BYTES = 96


def _spaced(line: Column) -> Column:
    """The words of a line with one space between them.

    Most lines are that already, and looking for other white space costs far less
    than matching a pattern at every space.
    """
    uneven = [F.contains(line, F.lit(c)) for c in ("  ", *_SPACES[1:])]
    even = F.when(reduce(Column.__or__, uneven), F.regexp_replace(line, r"\s+", " ")).otherwise(line)
    return F.btrim(even)


def _words(spaced: Column) -> Column:
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def _half_keys(words: Column, size: Column) -> Column:
    """Hashes of the leading and trailing words that one edit cannot both touch.

    Of two lines within one edit, the longer with n words, one half of
    (n - 1) // 2 words at an end is the same. A line does not know whether it is
    the longer, so it gives the halves for both cases.
    """
    keys = []
    for longer in (size, size + 1):
        half = F.floor((longer - 1) / 2).cast("int")
        keys += [
            F.xxhash64(F.lit("head"), half, F.slice(words, F.lit(1), half)),
            F.xxhash64(F.lit("tail"), half, F.slice(words, size - half + 1, half)),
        ]
    return F.array_distinct(F.array(*keys))


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))


def _line_hashes() -> list[Column]:
    return [F.xxhash64("spaced").alias("h1"), F.xxhash64(F.lit(1), "spaced").alias("h2")]


def _occurrences(docs: DataFrame, min_words: int, near_words: int) -> DataFrame:
    """One row per line of at least ``min_words`` words, without its text."""
    lines = docs.select(
        _doc().alias("doc"),
        row_key().alias("rid"),
        F.posexplode(F.split("text", "\n", -1)).alias("line", "chars"),
    )
    # what several columns read is computed once by a lateral step
    spaced = lines.withColumn("spaced", F.explode(F.array(_spaced(F.col("chars")))))
    worded = spaced.withColumn("words", F.explode(F.array(_words(F.col("spaced")))))
    sized = worded.withColumn("size", F.size("words")).where(F.col("size") >= min_words)
    halves = _half_keys(F.col("words"), F.col("size"))
    return sized.select(
        F.struct("doc", "line", "rid").alias("at"),
        *_line_hashes(),
        "size",
        # of two lines within one edit, one may have LONG words and the other one less
        F.when(F.col("size").between(near_words, LONG), halves).alias("halves"),
    )


def _sent_if_small(stored: DataFrame, numbers: str) -> DataFrame:
    """A stored table of line numbers per document, marked for broadcast if they fit.

    All numbers are counted, as a document may have very many lines.
    """
    rows, held = stored.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.size(numbers)), F.lit(0))
    ).first()
    return F.broadcast(stored) if rows * ROW_BYTES + held * 4 <= BROADCAST_BYTES else stored


def _read(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(at, h1, h2, words) of the lines in ``wanted`` (at), from their documents.

    Only line numbers travel to the documents; what else a line is known by comes
    from the document again.
    """
    per_doc = materialised(
        wanted.groupBy(F.col("at.rid").alias("rid")).agg(F.collect_set("at.line").alias("picks"))
    )
    return (
        docs.select(_doc().alias("doc"), row_key().alias("rid"), "text")
        .join(_sent_if_small(per_doc, "picks"), "rid")
        # a text is cut once, not once for each of its lines
        .select("doc", "rid", "picks", F.explode(F.array(F.split("text", "\n", -1))).alias("lines"))
        .select("doc", "rid", "lines", F.explode("picks").alias("line"))
        .select(
            F.struct("doc", "line", "rid").alias("at"),
            F.explode(F.array(_spaced(F.get("lines", "line")))).alias("spaced"),
        )
        .select("at", *_line_hashes(), F.explode(F.array(_words(F.col("spaced")))).alias("words"))
    )


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, h1, h2, words) of the lines in ``wanted`` (at, h1, h2).

    Ids follow the order of ``at``: the earlier line has the smaller one.
    """
    found = _read(docs, wanted).dropDuplicates(["h1", "h2"])
    # numbered along a range sort and stored, so the numbers are in order and fixed
    return materialised(
        found.orderBy("at", "h1", "h2")
        .select(F.monotonically_increasing_id().alias("id"), "h1", "h2", "words")
    )


def _variants(texts: DataFrame) -> DataFrame:
    """Hashed keys of each line: one per word left out, twice, and one for the whole.

    A sequence is hashed as the sum over its words of a hash of word and place.
    Leaving out word i moves the later ones up by one place, so the sum is that of
    the earlier words plus that of the later ones one place on: both are running
    sums over the line. Keys with a place join lines of equal length that differ
    in that one place; keys without join a shortened line to a whole one.
    """
    words = texts.select(
        "id", F.size("words").alias("n"), F.posexplode("words").alias("i", "word")
    ).select(
        "id", "n", "i",
        F.xxhash64("word", "i").bitwiseAND(F.lit(_SHARE)).alias("here"),
        F.xxhash64("word", F.col("i") - 1).bitwiseAND(F.lit(_SHARE)).alias("moved"),
    )
    line = Window.partitionBy("id")
    upto = line.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = words.select(
        "id", "n", "i",
        (F.sum("here").over(upto) - F.col("here")).alias("before"),
        (F.sum("moved").over(line) - F.sum("moved").over(upto)).alias("after"),
        F.sum("here").over(line).alias("whole"),
    )
    rest = F.col("before") + F.col("after")

    def emitted(role: int, *parts) -> Column:
        return F.struct(F.xxhash64(*parts).alias("key"), F.lit(role).cast("byte").alias("role"))

    nowhere = F.lit(-1)
    per_word = F.array(
        emitted(REPLACED, F.col("n"), F.col("i"), rest),
        emitted(SHORTENED, F.col("n") - 1, nowhere, rest),
    )
    per_line = F.array(emitted(WHOLE, F.col("n"), nowhere, F.col("whole")))
    return summed.select(
        "id", F.explode(F.when(F.col("i") == 0, F.concat(per_word, per_line)).otherwise(per_word)).alias("e")
    ).select("id", "e.key", "e.role")


def _within_one_edit(a: Column, b: Column) -> Column:
    """Whether two word sequences differ by at most one word, exactly."""
    same_size = F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda d: d)) <= 1

    def one_more(long: Column, short: Column) -> Column:
        differ = F.zip_with(F.slice(long, F.lit(1), F.size(short)), short, lambda x, y: x != y)
        place = F.coalesce(F.array_position(differ, True), F.lit(0)).cast("int")
        place = F.when(place == 0, F.size(short) + 1).otherwise(place)
        rest = F.size(short) - place + 1
        return F.slice(long, place + 1, rest) == F.slice(short, place, rest)

    return (
        F.when(F.size(a) == F.size(b), same_size)
        .when(F.size(a) == F.size(b) + 1, one_more(a, b))
        .when(F.size(b) == F.size(a) + 1, one_more(b, a))
        .otherwise(False)
    )


def _near_repeats(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(h1, h2) of distinct lines with ``halves`` and an earlier one within one edit."""
    halves = distinct.where("halves is not null").select(
        "at", "h1", "h2", F.explode("halves").alias("half")
    )
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("half")
    wanted = halves.join(shared, "half").select("at", "h1", "h2").distinct()
    texts = _texts(docs, wanted)
    variants = _variants(texts)

    def first(role: int) -> Column:
        return F.min(F.when(F.col("role") == role, F.col("id")))

    earliest = variants.groupBy("key").agg(
        F.count(F.lit(1)).alias("c"),
        first(REPLACED).alias("replaced"),
        first(SHORTENED).alias("shortened"),
        first(WHOLE).alias("whole"),
    ).where("c > 1")
    witness = (
        F.when(F.col("role") == REPLACED, F.col("replaced"))
        .when(F.col("role") == SHORTENED, F.col("whole"))
        .otherwise(F.col("shortened"))
    )
    found = (
        variants.join(earliest, "key")
        .select("id", witness.alias("witness"))
        .where("witness < id")
        .distinct()
    )
    other = texts.select(F.col("id").alias("witness"), F.col("words").alias("other"))
    return (
        found.join(texts, "id")
        .join(other, "witness")
        .where(_within_one_edit(F.col("words"), F.col("other")))
        .select("h1", "h2")
        .distinct()
    )


def _runs(lines: DataFrame, with_parities: bool = False) -> DataFrame:
    """``lines`` (.., words) with n words and, instead of them, hashes of all runs."""
    if with_parities:
        lines = _with_parities(lines)
    n = F.size("words")
    together = F.arrays_zip(*[F.slice("words", F.lit(1 + d), n - (RUN - 1)) for d in range(RUN)])
    runs = F.transform(together, lambda run: F.xxhash64(run))
    return lines.select(
        *[c for c in lines.columns if c != "words"],
        n.alias("n"),
        F.array_distinct(runs).alias("runs"),
    )


def _class(run: Column) -> Column:
    return run.bitwiseAND(F.lit(CLASSES - 1)).cast("int")


def _crowded(docs: DataFrame, long: DataFrame) -> bytes:
    """Per class of runs, 1 if lines of a sample have runs of it far above the average."""
    sample = smallest_hashes(long.select("h1", "h2", "at"), "h1", SAMPLE_LINES)
    counted = (
        _runs(_read(docs, sample))
        .select(F.explode("runs").alias("run"))
        .groupBy(_class(F.col("run")).alias("class"))
        .agg(F.count(F.lit(1)).alias("c"))
        .collect()
    )
    bound = 8 + 4 * sum(r["c"] for r in counted) / CLASSES
    out = bytearray(CLASSES)
    for r in counted:
        out[r["class"]] = r["c"] > bound
    return bytes(out)


def _parities(hashes: str) -> list[Column]:
    """128 bits: whether the words that fall to each bit are odd in number.

    A word replaced changes two bits at most, one put in or left out a single one.
    """
    def odd(half: int) -> Column:
        def bit(h: Column) -> Column:
            mine = F.shiftright(h, 62).bitwiseXOR(F.lit(1 - half)).bitwiseAND(F.lit(1))
            return F.call_function("shiftleft", mine, h.bitwiseAND(F.lit(63)).cast("int"))

        return F.aggregate(hashes, F.lit(0).cast("long"), lambda x, h: x.bitwiseXOR(bit(h)))

    return [odd(half).alias(f"odd{half}") for half in (0, 1)]


def _with_parities(lines: DataFrame) -> DataFrame:
    """``lines`` (.., words) with the parities of their words."""
    hashed = lines.withColumn(
        "each", F.explode(F.array(F.transform("words", lambda w: F.xxhash64(w))))
    )
    return hashed.select(*lines.columns, *_parities("each"))


def _first_runs(docs: DataFrame, long: DataFrame) -> DataFrame:
    """(at, h1, h2, n, need, keys): the first runs of each line, how many to share.

    A line of so few different runs that all of them are keys shares one at least.
    """
    crowded = _crowded(docs, long)
    lines = _runs(_read(docs, long.select("at", "h1", "h2")))
    ordered = F.sort_array("runs")
    if any(crowded):
        often = F.filter("runs", lambda run: F.substring(F.lit(crowded), _class(run) + 1, 1) == F.lit(b"\x01"))
        lines = lines.withColumn("often", F.explode(F.array(often)))
        ordered = F.concat(F.sort_array(F.array_except("runs", "often")), F.sort_array("often"))
    most = RUN * F.floor(F.col("n") / 10).cast("int") + SHARED
    return lines.withColumn("keys", F.slice(ordered, F.lit(1), most)).select(
        "at", "h1", "h2", "n",
        F.when(F.size("keys") >= most, SHARED).otherwise(1).alias("need"),
        "keys",
    )


def _spelt(codes: Column) -> Column:
    """A text with one character per number; surrogates are no characters."""
    characters = F.transform(
        codes, lambda c: F.lpad(F.hex(F.when(c < 0xD800, c).otherwise(c + 0x800)), 8, "0")
    )
    return F.decode(F.unhex(F.array_join(characters, "")), "UTF-32")


def _spelling(texts: DataFrame) -> DataFrame:
    """``texts`` with the text that 19-bit codes of their words spell."""
    # five digits, of which the first is 8 or more: no padding, and never a surrogate
    codes = F.transform(
        "words", lambda w: F.hex(F.xxhash64(w).bitwiseAND(F.lit(2**19 - 1)).bitwiseOR(F.lit(2**19)))
    )
    digits = F.concat(F.lit("000"), F.array_join(codes, "000"))
    return texts.withColumn("spelt", F.decode(F.unhex(digits), "UTF-32"))


def _within_a_tenth(pairs: DataFrame) -> DataFrame:
    """Pairs whose words differ by a tenth of the shorter's at most, exactly.

    Equal words have equal codes, so codes differ no more than words do, and as
    much if the pair has as many codes as words. In the few pairs where two words
    meet in a code, the words are numbered instead.
    """
    most = F.floor(F.least(F.size("words"), F.size("words_")) / 10).cast("int")
    alike = pairs.where(F.call_function("levenshtein", "spelt", "spelt_", most) >= 0).withColumn(
        "numbers", F.explode(F.array(F.array_distinct(F.concat("words", "words_"))))
    )
    codes = F.array_distinct(F.split(F.concat("spelt", "spelt_"), ""))
    told_apart = F.size("numbers") == F.size(codes)

    def numbered(words: str) -> Column:
        return _spelt(F.transform(words, lambda w: F.array_position("numbers", w)))

    exact = F.call_function("levenshtein", numbered("words"), numbered("words_"), most) >= 0
    return alike.where(F.when(told_apart, True).otherwise(exact))


def _pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """(id, id_): lines of ``left`` and earlier ones of ``right`` that may be within a tenth.

    Only numbers, lengths and parities meet, and a pair that cannot be near ends in the
    join: of lines that share keys, few rows are left to be counted.
    """
    earlier = right.select("key", *[F.col(c).alias(f"{c}_") for c in right.columns if c != "key"])
    fewest = F.floor(F.least("n", "n_") / 10)
    unlike = reduce(Column.__add__, [
        F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_"))) for c in ("odd0", "odd1")
    ])
    return (
        left.join(earlier, "key")
        .where(
            (F.col("id_") < F.col("id"))
            & (F.abs(F.col("n") - F.col("n_")) <= fewest)
            & (unlike <= 2 * fewest)
        )
        .groupBy("id", "id_")
        .agg(F.count(F.lit(1)).alias("c"), F.max(F.greatest("need", "need_")).alias("need"))
        .where("c >= need")
        .drop("c", "need")
    )


def _proven(docs: DataFrame, lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """The ids in ``pairs`` (id, id_) whose lines are within a tenth of each other."""
    pairs = materialised(pairs)
    ends = pairs.select("id").union(pairs.select("id_")).distinct()
    wanted = materialised(lines.join(ends, "id").select("id", "at", "h1", "h2"))
    read = _read(docs, wanted.select("at", "h1", "h2")).dropDuplicates(["h1", "h2"])
    texts = materialised(
        _spelling(read.drop("at")).join(wanted.select("id", "h1", "h2"), ["h1", "h2"]).drop("h1", "h2")
    )
    other = texts.select(*[F.col(c).alias(f"{c}_") for c in texts.columns])
    found = materialised(
        _within_a_tenth(pairs.join(texts, "id").join(other, "id_")).select("id").distinct()
    )
    for done in (pairs, wanted, texts):
        discard(done)
    return found


def _shares(long: DataFrame) -> int:
    """How many shares the keys of ``long`` are shuffled in: few keys go at once."""
    held = long.agg(F.sum(F.floor(F.col("n") / 10) * RUN + SHARED)).first()[0] or 0
    return min(SHARES, 1 + held // SHARE_KEYS)


def _near_long_repeats(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(h1, h2) of distinct lines of LONG words with an earlier one within a tenth.

    Lines are numbered in their order, so that what is shuffled and stored for each of
    their many keys is short; stored tables go as soon as nothing reads them.
    """
    long = materialised(_first_runs(docs, distinct.where(F.col("size") >= LONG)))
    every = long.select("h1", F.explode("keys").alias("key"))
    shares = _shares(long)
    met = []
    for share in range(shares):
        keys = every.where(F.pmod("key", F.lit(shares)) == share).repartition("key")
        shared = (
            keys.groupBy("key")
            .agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
            .where("low < high")
            .select("key")
        )
        met.append(materialised(keys.join(shared.hint("shuffle_hash"), "key").distinct()))
    every = reduce(DataFrame.unionAll, met)
    meeting = materialised(
        long.drop("keys").join(every.select("h1").distinct(), "h1", "left_semi").distinct()
    )
    discard(long)
    # the earliest of equal lines may be read twice where a document is there twice
    odd = _with_parities(_read(docs, meeting.select("at"))).drop("at", "words")
    # numbered along a range sort and stored, so the numbers are in order and fixed
    lines = materialised(
        meeting.join(odd.dropDuplicates(["h1", "h2"]), ["h1", "h2"])
        .orderBy("at", "h1", "h2")
        .select(
            F.monotonically_increasing_id().alias("id"),
            "at", "h1", "h2", "odd0", "odd1", "n", "need",
        )
    )
    discard(meeting)
    held = materialised(every.join(lines.drop("at", "h2"), "h1").drop("h1"))
    for done in met:
        discard(done)
    facts = F.struct("id", *[c for c in held.columns if c not in ("id", "key")])
    first = held.groupBy("key").agg(F.min(facts).alias("w")).select("key", "w.*")
    easy = _proven(docs, lines, _pairs(held, first))
    others = _proven(docs, lines, _pairs(held.join(easy, "id", "left_anti"), held))
    found = materialised(lines.join(easy.union(others), "id").select("h1", "h2").distinct())
    for done in (held, easy, others, lines):
        discard(done)
    return found


def repeated_lines(docs: DataFrame, min_words: int = 5, near_words: int = 10) -> DataFrame:
    """(rid, dropped): per document with any, the numbers of the lines that go, from 0.

    ``rid`` is :func:`tidemark.llm.common.row_key`. Earlier means a smaller doc_id,
    then a smaller line number; NULL ids come last. Lines of fewer than
    ``min_words`` words never go; lines of fewer than ``near_words`` only for an
    equal one. Of lines with ``LONG`` words or more, a tenth of the shorter one's
    words may differ, otherwise one word.

    Before any variant is emitted, lines that share neither their leading nor
    their trailing half with another line are left out: one edit leaves one of
    the halves as it is, so they cannot repeat anything. Every line found is held
    against its earlier line word by word.
    """
    occurrences = materialised(_occurrences(docs, min_words, near_words))
    distinct = materialised(
        occurrences.groupBy("h1", "h2").agg(
            F.min("at").alias("at"),
            F.count(F.lit(1)).alias("times"),
            F.first("size").alias("size"),
            F.first("halves").alias("halves"),
        )
    )
    near = _near_repeats(docs, distinct).union(_near_long_repeats(docs, distinct))
    near = near.distinct().withColumn("near", F.lit(True))
    verdicts = materialised(
        distinct.select("h1", "h2", F.col("at").alias("first"), "times")
        .join(near, ["h1", "h2"], "left")
        .where("times > 1 or near")
        .select("h1", "h2", "first", "near")
    )
    return (
        occurrences.select("at", "h1", "h2")
        .join(verdicts, ["h1", "h2"])
        .where("near or at > first")
        .groupBy(F.col("at.rid").alias("rid"))
        .agg(F.collect_set("at.line").alias("dropped"))
    )


def dedup_lines(docs: DataFrame, min_words: int = 5, near_words: int = 10) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, plus n_lines and n_dropped.

    Lines end at line feeds; what remains is joined by them again, white space
    untouched. See :func:`repeated_lines` for what goes.

    A NULL text stays NULL with n_lines 0. An empty text is one line of no words
    and stays. Rows that repeat both id and text are one document: they get the
    same text. Rows that share only the id are two documents, ordered by a hash of
    the text where lines tie. Columns of ``docs`` keep their names; n_lines and
    n_dropped get an underscore where they clash. An empty table gives no rows.
    """
    n_lines, n_dropped = (column_like(n, docs.columns) for n in ("n_lines", "n_dropped"))
    rid, dropped = (column_like(n, docs.columns) for n in ("rid", "dropped"))
    found = materialised(repeated_lines(docs, min_words, near_words))
    found = found.select(F.col("rid").alias(rid), F.col("dropped").alias(dropped))
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda _, i: ~F.array_contains(F.col(dropped), i))
    text = F.when(F.col(dropped).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return (
        docs.withColumn(rid, row_key())
        .join(_sent_if_small(found, dropped), rid, "left")
        .withColumns(
            {
                n_lines: F.coalesce(F.size(lines), F.lit(0)).cast("long"),
                n_dropped: F.coalesce(F.size(dropped), F.lit(0)).cast("long"),
                "text": text,
            }
        )
        .select(*docs.columns, n_lines, n_dropped)
    )


def without_repeated_lines(
    docs: DataFrame, min_words: int = 5, near_words: int = 10
) -> DataFrame:
    """Columns of ``docs``; documents of which every line went are gone themselves."""
    out = dedup_lines(docs, min_words, near_words)
    n_lines, n_dropped = out.columns[-2:]
    whole = F.col(n_lines) > F.col(n_dropped)
    return out.where(whole | (F.col(n_lines) == 0)).select(*docs.columns)
