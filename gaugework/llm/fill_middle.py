"""Fill-in-middle transformation by counted quantifiers.

``regexp_count`` gives the number n of units (tokens) of a text. From hashes of the document id follow the cuts
a <= b within 0 .. n, and the pattern of that row is ``\\A((?:unit){a}+)((?:unit){b-a}+)(.*+)\\z``: its counted
possessive groups take exactly a and b - a units, without backtracking and without recursion for any count, so
one match yields prefix, middle and suffix and writes them in the order of the form between sentinels. The
alternatives of the unit are possessive, too; they take what greedy ones would, since white space is never a
token's other half.

A text that holds one of the sentinels stays as it is, which is why a written output can be taken apart again:
no sentinel can arise where two parts meet, as each begins with ``<`` and ends with ``>``.

Defined results: a null text counts as empty; empty texts stay plain; a null doc_id is hashed as the empty
string; repeated rows give repeated results; an empty table gives an empty result; other columns are ignored.
Everything is a column expression over single rows: no shuffle, whatever the size of a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import query, table, text_or_empty

#: Unit of a text, sentinels, seed, shares of transformed texts and of suffix-first ones.
SPACE = r"[\x20\x09-\x0D]"
OTHER = r"[^\x20\x09-\x0D]"
UNIT = f"{SPACE}*+{OTHER}++|{SPACE}++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, RATE, SUFFIX_FIRST = 42, 50, 80


def _draw(digest: Column, number: int) -> Column:
    """The given group of eight digits of a hexadecimal digest, counted from 0, as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * number + 1, 8), 16, 10).cast("long")


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, text, n, form, first, last, output for every row of ``docs`` (doc_id, text).

    ``first`` and ``last`` are the cuts in units. ``rate`` is the percentage of texts that are transformed,
    ``suffix_first`` that of the suffix-first form among them.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    rows = rows.select("doc_id", "text", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"), digest.alias("digest"))
    cuts = [F.pmod(_draw(F.col("digest"), i), F.col("n") + 1) for i in (0, 1)]
    marked = F.contains("text", F.lit(PREFIX)) | F.contains("text", F.lit(SUFFIX)) | F.contains("text", F.lit(MIDDLE))
    plain = (F.col("n") == 0) | marked | (_draw(F.col("digest"), 2) % 100 >= rate)
    form = F.when(plain, "plain").when(_draw(F.col("digest"), 3) % 100 < suffix_first, "spm").otherwise("psm")
    rows = rows.select("doc_id", "text", "n", form.alias("form"), F.least(*cuts).alias("first"), F.greatest(*cuts).alias("last"))
    pattern = F.format_string(rf"(?s)\A((?:{UNIT}){{%d}}+)((?:{UNIT}){{%d}}+)(.*+)\z", F.col("first"), F.col("last") - F.col("first"))
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    return rows.withColumn("output", output)


def parts(output: Column, form: Column) -> Column:
    """Prefix, middle and suffix that an output of the given form was written from; null for a plain one."""
    cut = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    at = F.when(form == "spm", F.array(F.lit(2), F.lit(3), F.lit(1))).otherwise(F.array(F.lit(1), F.lit(3), F.lit(2)))
    return F.when(form != "plain", F.transform(at, lambda i: F.element_at(cut, i + 1)))


def restored(output: Column, form: Column) -> Column:
    """The exact text, rebuilt from an output and its form."""
    return F.when(form == "plain", output).otherwise(F.array_join(parts(output, form), ""))


@query(
    "op11_counted_fill_middle",
    r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    u AS (SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
        list_transform(range(0, 4), lambda g: list_sum(list_transform(range(1, 9), lambda i:
            CAST((strpos('0123456789abcdef', h[8 * g + i]) - 1) * power(16, 8 - i) AS BIGINT)))) AS k FROM d),
    c AS (SELECT doc_id, text, units, len(units) AS n,
        CAST(least(k[1] % (len(units) + 1), k[2] % (len(units) + 1)) AS BIGINT) AS a, CAST(greatest(k[1] % (len(units) + 1), k[2] % (len(units) + 1)) AS BIGINT) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR k[3] % 100 >= 50 THEN 'plain'
            WHEN k[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
    p AS (SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:], '') AS s FROM c)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
        sha256(text) AS restored_sha256 FROM p
    """,
)
def op11_counted_fill_middle(spark, folder):
    """Form, cuts and digests of every whole text, transformed and rebuilt."""
    found = transform(table(spark, folder, "documents").select("doc_id", "text"))
    cut = parts(F.col("output"), F.col("form"))
    found = found.select("doc_id", "n", "form", "output", cut.alias("cut"), restored(F.col("output"), F.col("form")).alias("text"))
    return found.select(
        "doc_id",
        "n",
        "form",
        F.length(F.col("cut")[0]).cast("long").alias("prefix_chars"),
        F.length(F.col("cut")[1]).cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("text", 256).alias("restored_sha256"),
    )
