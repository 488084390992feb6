"""Spelling variants: each word's commonest near word, over groups that never list a pair.

Two words are near if they differ by one replaced, inserted or deleted code point. A word has a key for each position
with that position wild (prefix, a mark, suffix), a key for each distinct deletion, and itself as a key. Rows of equal
keys are a group, in one exchange. Words under one wild key differ at that position alone: each has the rest of the
group as near words, the best of which is the group's first or, for the first itself, its second. Under a key without
a mark stand the word that it spells, if there is one, and the words from which one deletion makes it: the word's near
words by insertion are all of those, and each of those has the word. So every row carries a count and one best word,
and a word's rows are summed. A group has at most as many members as there are letters (for deletions, times the
places), whatever the corpus, and no row holds a pair but for a word and a deletion of it that is a word.

Following forms to the last: a form has at least `factor` times the occurrences of its word, so chains are no longer
than the logarithm of the largest count, and the steps are doubled in each round.

Defined cases. Null text: no words; null id: as empty text. Repeated rows and ids: each row counts. Ties between near
words: the smaller in code-point order. Empty table: no rows. Other columns have no effect. Texts are read whole; very
long ones and very long words too.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import give_back, prepare, text_of, written
from .words import LOWER

RUN = re.compile("[a-zÀ-ÿ]+")
#: Words that a task counts before it hands their counts on.
HELD = 1 << 18


def counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", modulus: int | None = 97, held: int = HELD) -> DataFrame:
    """(word, n): the lower-cased runs of letters of all texts, counted.

    modulus: a run loses a code point, by the hash of its document's id and itself, where that hash is divisible by it
    (which plants misspellings); None: never.
    """
    prepare(docs.sparkSession)
    source = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"), text_of(docs, text_col).alias("text"))

    def run(batches):
        number: Counter = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(list(number), pa.string()), pa.array(list(number.values()), pa.int64())], names=["word", "n"])
            number.clear()
            return batch

        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.large_binary()), strict=True):
                here = Counter(RUN.findall(text.as_py().translate(LOWER).decode()))
                if modulus:
                    seed = zlib.crc32(f"{key}:".encode())
                    for w in [w for w in here if zlib.crc32(w.encode(), seed) % modulus == 0]:
                        at = zlib.crc32(w.encode(), seed) % len(w)
                        number[w[:at] + w[at + 1 :]] += here.pop(w)
                number.update(here)
                if len(number) > held:
                    yield out()
        if number:
            yield out()
        give_back()

    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def nearest(vocabulary: DataFrame) -> DataFrame:
    """(word, n, n_near, best: struct(n, word) of the near word of largest n, or null) for each row of (word, n); words
    are distinct, and of letters without the mark `*`."""
    # rows of a group: the word that the key spells comes first (own), then the commonest
    wild = F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.struct(F.concat(F.substring("word", F.lit(1), i - 1), F.lit("*"), F.substring("word", i + 1, F.length("word"))).alias("key"), F.lit(2).alias("kind")))
    fewer = F.filter(F.sequence(F.lit(1), F.length("word")), lambda i: F.substring("word", i, F.lit(1)) != F.substring("word", i + 1, F.lit(1)))  # the last of equal letters stands for all
    shorter = F.transform(fewer, lambda i: F.struct(F.concat(F.substring("word", F.lit(1), i - 1), F.substring("word", i + 1, F.length("word"))).alias("key"), F.lit(1).alias("kind")))
    itself = F.array(F.struct(F.col("word").alias("key"), F.lit(0).alias("kind")))
    rows = vocabulary.select("word", "n", F.inline(F.concat(itself, shorter, wild)))
    group = Window.partitionBy("key")
    order = group.orderBy("kind", F.desc("n"), "word")
    me = F.struct((-F.col("n")).alias("less"), "word")
    rows = rows.select("word", "n", "kind", F.row_number().over(order).alias("place"), F.first(F.struct("kind", me.alias("row"))).over(order).alias("first"), F.lead(me).over(order).alias("second"), F.count(F.lit(1)).over(group).alias("size"))
    spelt = F.col("first.kind") == 0
    near = F.when((F.col("kind") == 2) | (F.col("kind") == 0), F.col("size") - 1).when(spelt, F.lit(1)).otherwise(F.lit(0))
    best = F.when((F.col("kind") == 1) & ~spelt, F.lit(None)).when(F.col("place") == 1, F.col("second")).otherwise(F.col("first.row"))
    rows = rows.select("word", "n", near.alias("near"), best.alias("best"), "kind").filter((F.col("near") > 0) | (F.col("kind") == 0))
    out = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))
    return out.select("word", "n", "n_near", F.when(F.col("best").isNotNull(), F.struct((-F.col("best.less")).alias("n"), F.col("best.word").alias("word"))).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each row of (word, form) with a form: the last of its chain; twice as far in each round."""
    at = written(forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = at.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        at = written(moved, "roots")
        if not at.filter("moved").limit(1).count():
            return at.select("word", "root")
        at = at.select("word", "root")


def variants(vocabulary: DataFrame, *, factor: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of (word, n): form is the near word of largest n if that is at
    least `factor` times the word's own, root the last of the chain of forms (the word itself if it has no form).

    factor: above 1, or chains might not end.
    """
    if factor <= 1:
        raise ValueError("factor must be above 1")
    near = written(nearest(vocabulary), "near")
    taken = F.col("best.n") >= factor * F.col("n")
    out = near.select("word", "n", "n_near", F.when(taken, F.col("best.word")).alias("form"), F.when(taken, F.col("best.n")).alias("form_n"))
    found = roots(out)
    return out.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def vocabulary(docs: DataFrame, *, least_length: int = 5, least: int = 3, **how) -> DataFrame:
    """(word, n) of the words of enough code points and occurrences."""
    return counts(docs, **how).filter((F.length("word") >= least_length) & (F.col("n") >= least))


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """The form, the root and the number of near words of every word of `documents`."""
    return variants(vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet")))


SQL = r"""
WITH RECURSIVE t AS (SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(list_prepend(i::BIGINT, [k::BIGINT for k in range(8)]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(i))),
d AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+') AS ws FROM documents),
r AS (SELECT id, w, count(*) AS n FROM (SELECT id, unnest(ws) AS w FROM d) GROUP BY ALL),
b AS (SELECT id, w, n, hex(encode(id || ':' || w)) AS x FROM r),
h AS (SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [('0x' || substr(x, 2 * k - 1, 2))::BIGINT for k in range(1, len(x) // 2 + 1)]), lambda c, y: xor(crc[(xor(c, y) & 255) + 1], c >> 8))) AS h FROM b, t),
v AS (SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % len(w))::INT) || substr(w, (h % len(w))::INT + 2) ELSE w END AS word, n FROM h) GROUP BY word HAVING len(word) >= 5 AND sum(n) >= 3),
e AS (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM v),
wild AS (SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS k FROM e),
del AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS k FROM e),
pairs AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM wild a JOIN wild b ON a.k = b.k AND a.word <> b.word
  UNION ALL SELECT del.word, del.n, v.word, v.n FROM del JOIN v ON v.word = k
  UNION ALL SELECT v.word, v.n, del.word, del.n FROM del JOIN v ON v.word = k),
near AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS best, max(other_n) AS best_n FROM pairs GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * v.n THEN best END AS form, CASE WHEN best_n >= 2 * v.n THEN best_n END AS form_n FROM v LEFT JOIN near USING (word)),
c AS (SELECT word, word AS at FROM f UNION ALL SELECT c.word, f.form FROM c JOIN f ON f.word = c.at WHERE f.form IS NOT NULL),
last AS (SELECT c.word, c.at AS root FROM c JOIN f ON f.word = c.at WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN last USING (word)
"""
