"""Order MinHash of documents, in DataFrame functions only.

A text is a sequence of units: runs of visible characters, and single characters of scripts written without blanks. Runs
of over 24 characters are cut where their content says so, so that a change within one leaves its other parts as they
are. A k-mer is k neighbouring units. Each k-mer is numbered by its occurrence in the text, and the hash of k-mer and
number puts the pair into one of the bins and gives its rank there. From each bin the least pairs are taken, put back
into the order in which they stand in the text, and their k-mers are hashed as a tuple. Two texts have a bin's tuple in
common if they share its k-mers, how often these occur, and their order; so the share of common bins falls with the edit
distance, and not only with the sets of k-mers.

One hash for all bins, in place of one permutation for each sketch, makes the work for a text independent of the number
of bins. A bin that a text with few k-mers leaves without its full number of pairs borrows the least ones of the next
bins, around the circle of bins; so short texts have tuples with an order in all bins, too.

Sorting uses single longs: 33 bits of hash and 31 of place, which is more than the places that a string can have.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 3
BINS = 64
LEAST = 2

_BITS = 31
_PLACE = (1 << _BITS) - 1
_HASH = ~_PLACE
#: Units: one character of CJK, Hangul, Thai, Lao, Khmer or Myanmar script; the rest of a run of other visible ones, if it is up to 24; else its beginning up to one of the characters after which runs are cut (about a quarter of those of encoded data), 8 at least and 63 at most.
_ALONE = r"฀-໿က-႟ក-៿⺀-鿿가-힯"
_RUN = rf"[^\s{_ALONE}]"
UNIT = rf"[{_ALONE}]|{_RUN}{{1,24}}(?!{_RUN})|{_RUN}{{7,62}}?[aeiouAEIOU0369/+.,;=&]|{_RUN}{{1,63}}"


def with_fingerprint(df: DataFrame, text_col: str, to: str) -> DataFrame:
    """Adds array<bigint> `to`: for each bin, the bin's number in bits 32 to 37 and 32 bits of its tuple's hash.

    A null text counts as empty, and has no bins. Equal texts have equal fingerprints. Every step is a column of its
    own that is used more than once, so that none is worked out again for each element of an array.
    """
    sixth = 64 - int(math.log2(BINS))
    same = lambda a, b: f"shiftrightunsigned({a}, {sixth}) = shiftrightunsigned({b}, {sixth})"
    get = lambda array, i: f"get({array}, int({i}))"
    steps = {
        "__units": F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(UNIT), F.lit(0)),
        "__kmers": F.expr(f"IF(size(__units) = 0, array(), transform(sequence(0, greatest(0, size(__units) - {K})), i -> xxhash64({', '.join(get('__units', f'i + {j}') for j in range(K))})))").cast("array<bigint>"),
        "__sorted": F.expr(f"sort_array(transform(__kmers, (x, i) -> (x & {_HASH}L) | bigint(i)))"),
        "__starts": F.expr(f"filter(sequence(0, size(__sorted)), i -> i < size(__sorted) AND (i = 0 OR shiftright({get('__sorted', 'i')}, {_BITS}) <> shiftright({get('__sorted', 'i - 1')}, {_BITS})))"),
        "__pairs": F.expr(
            f"sort_array(IF(size(__starts) = size(__sorted), transform(__sorted, x -> (xxhash64(shiftright(x, {_BITS}), 0) & {_HASH}L) | (x & {_PLACE}L)), "
            f"flatten(transform(__starts, (b, j) -> transform(slice(__sorted, b + 1, coalesce({get('__starts', 'j + 1')}, size(__sorted)) - b), (x, o) -> (xxhash64(shiftright(x, {_BITS}), o) & {_HASH}L) | (x & {_PLACE}L))))))"
        ),
        "__least": F.expr(f"filter(__pairs, (x, i) -> i < {LEAST} OR NOT {same('x', get('__pairs', f'i - {LEAST}'))})"),
        "__firsts": F.expr(f"filter(sequence(0, size(__least)), i -> i < size(__least) AND (i = 0 OR NOT {same(get('__least', 'i'), get('__least', 'i - 1'))}))"),
        "__ring": F.expr(f"concat(__least, slice(__least, 1, {LEAST}))"),
        "__bins": F.expr(f"transform(__firsts, b -> int(shiftright({get('__least', 'b')}, {sixth})))"),  # ascending from -BINS / 2, as longs are sorted
        "__tuples": F.expr(
            f"transform(transform(__firsts, b -> array_sort(transform(slice(__ring, b + 1, least({LEAST}, size(__least))), x -> struct(x & {_PLACE}L AS place, x AS pair)))), "
            f"t -> xxhash64(array_join(transform(t, y -> hex({get('__kmers', 'y.place')})), ' ')) & 4294967295L)"
        ),
        to: F.expr(
            f"concat(flatten(transform(__tuples, (t, j) -> transform(sequence(coalesce({get('__bins', 'j - 1')}, {-BINS // 2 - 1}) + 1, {get('__bins', 'j')}), b -> shiftleft(bigint(b & {BINS - 1}), 32) | t))), "
            f"IF({get('__bins', 'size(__bins) - 1')} < {BINS // 2 - 1}, transform(sequence({get('__bins', 'size(__bins) - 1')} + 1, {BINS // 2 - 1}), b -> shiftleft(bigint(b & {BINS - 1}), 32) | {get('__tuples', '0')}), array()))"
        ).cast("array<bigint>"),
    }
    for name, value in steps.items():
        df = df.withColumn(name, value)
    return df.drop(*[x for x in steps if x != to])


def as_string(fingerprint: Column) -> Column:
    """Ten hexadecimal digits for each bin; an empty string for a text without units."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 10, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of bins in use whose tuples agree, from 0 to 1; 1 for two empty fingerprints."""
    bins = lambda x: F.transform(x, lambda y: F.shiftright(y, 32))
    used = F.size(F.array_union(bins(a), bins(b)))
    return F.when(used == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(used, F.lit(1))).cast("double")


def with_next(docs: DataFrame, id_col: str, text_col: str, also: list[str], buckets: int | None = None) -> DataFrame:
    """Adds `next_text` and `next_<name>` for each name in `also`: those of the document with the next smaller id, and after the last one those of the first.

    Rows of one id follow in the order of their texts; null ids come last. (If no id is set, the last row's next text is
    null.) The ids are cut into ranges at approximate quantiles that are themselves ids, so each range's first row is
    known in advance: it goes to the range before as well, and no range needs another. One shuffle by range moves the
    texts once; a range's rows may spill.
    """
    spark = docs.sparkSession
    n = min(buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), 100_000)
    cuts = docs.agg(F.percentile_approx(id_col, [1 - i / n for i in range(n)], 20 * n)).head()[0]
    cuts = sorted(set(cuts or [0]), reverse=True)
    step = max(1, math.isqrt(len(cuts)))
    i = F.col(id_col)
    coarse = F.size(F.filter(F.lit(cuts[::step]), lambda b: b >= i)) - 1
    fine = F.size(F.filter(F.slice(F.lit(cuts), F.greatest(coarse, F.lit(0)) * step + 1, F.lit(step)), lambda b: b >= i)) - 1
    bucket = F.when(i.isNull(), len(cuts) - 1).otherwise(F.greatest(coarse, F.lit(0)) * step + fine)
    placed = docs.select("*", bucket.alias("__bucket"))
    before = F.pmod(F.col("__bucket") - 1, F.lit(len(cuts)))
    first = F.get(F.lit(cuts), F.col("__bucket")) == i
    places = F.when(first, F.array(F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("guest")), F.struct(before.alias("b"), F.lit(True).alias("guest")))).otherwise(F.array(F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("guest"))))
    sent = placed.select("*", F.explode(places).alias("__at")).select(*docs.columns, F.col("__at.b").alias("__bucket"), F.col("__at.guest").alias("__guest"))
    order = Window.partitionBy("__bucket").orderBy("__guest", i.desc_nulls_last(), text_col)
    follow = sent.select("*", F.lead(text_col).over(order).alias("next_text"), *(F.lead(x).over(order).alias(f"next_{x}") for x in also))
    return follow.where(~F.col("__guest")).drop("__bucket", "__guest")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns id_col, `text` (null: empty) and `fingerprint` array<bigint> of every whole text. Repeated rows are all there; other columns are not read; an empty table gives an empty table. No shuffle."""
    return with_fingerprint(docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")), "text", "fingerprint")


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document beside an edited form, whose second half is the beginning of the next document's text.

    Returns id_col, `text`, `fingerprint`, `edited` string, `edited_fingerprint`, `next_fingerprint`. Ids are whole
    numbers; see with_next for nulls and repeated ids. A text of one character, or none, is its own edited form.
    """
    rows = with_next(fingerprints(docs, id_col, text_col), id_col, "text", ["fingerprint"])
    half = F.expr("int(length(text) div 2)")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    none = F.array().cast("array<bigint>")
    rows = rows.select(id_col, "text", "fingerprint", edited.alias("edited"), F.coalesce("next_fingerprint", none).alias("next_fingerprint"))
    return with_fingerprint(rows, "edited", "edited_fingerprint")
