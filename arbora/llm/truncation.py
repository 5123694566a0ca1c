"""Texts cut off before their end, found by self-joins on prefixes.

Two joins look for values that are strict prefixes of longer copies elsewhere:

* whole texts: texts hash their prefixes of fixed lengths, so that only texts that share a long prefix
  with another one meet; within such a group the exact lengths of the shorter ones are looked up. Whole
  short texts begin others by chance; of one record (same label and time) the shorter text is cut anyway.
* phrases: the last word of a text, with the two words before it, against all phrases of the corpus
  that begin alike. A phrase that elsewhere only goes on (longer last word, or more words in the same
  sentence) and never ends there is cut; so is one whose context never ends a sentence. Digits compare
  as one figure. All counts are numbers of distinct texts, over all words of all texts, aggregated before
  they move; copies of a text are judged once, and a text is no evidence about itself.

A closing formula may look like a cut, so a phrase that ends a share of the texts that hold it is an end;
shares, unlike counts, mean the same at every size. A mark that stands for the rest settles it, except
dots, which also close whole texts: there the words before the dots are looked up, with and without them.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arbora.llm.tokens import spread
from arbora.util import Stage, trimmed

_WIDE = r"぀-ヿ㐀-鿿　-〿＀-￯"
TOKEN = rf"(?U)(\n|[{_WIDE}]|[^\s{_WIDE}]+)"
CLOSED = r"[.?!。！？][\"'”’)」]*+$"
#: Marks that stand for a rest, at the end of a text.
MARK = r"(?:\[\s*(?:\.\.\.|…)\s*\]|\[truncated\]|<cut>|>>|\((?:[0-9]/[0-9]|more|cont\.?)\)|\s[0-9]/[0-9]|\s\+|�)$"
DOTS = r"(?:…|\.\.)$"
#: Structured text, and its ends.
OPENS, SHUTS = r"^(?:\{\s*\"|\[\s*[{\[\"])", r"[}\]]$"
#: Characters at the end of a text in which marks are looked for.
TAIL = 40
BULLET = r"^(?:[*•\-–]|[0-9]+[).])$"
#: Prefix lengths of whole texts, in characters.
GRID = [*range(1, 16), *[int(16 * 1.3**i) for i in range(60)]]
#: A phrase is an end if texts stop there at least so often, as a share of those that go on.
SHARE = 0.2


def _class(w: Column) -> Column:
    c = w.substr(1, 1)
    return F.when(c.rlike(rf"[{_WIDE}]"), "w").when(c.rlike(r"\p{L}"), "l").when(c == "0", "0").otherwise("p")


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.regexp_replace(text, r"\p{Nd}+", "0"), F.lit(TOKEN), 1)


def _undotted(w: Column) -> Column:
    """Without dots at the end, if something is left."""
    bare = F.regexp_replace(w, r"(?<![\s.…])[\s.…]++$", "")
    return F.when((w.endswith("..") | w.endswith("…")) & bare.rlike(r"[^\s.…]"), bare).otherwise(w)


def _phrases(t: Column, dots: Column) -> Column:
    """Of each token: the two before it, itself, and c (more follows), e (ends a unit), f (ends the text) or
    d (ends either in dots, which are taken off). dots: whether they were taken off the text's end."""
    n = F.size(t)

    def one(w: Column, i: Column) -> Column:
        nx = F.get(t, i + 1)
        starts = ~F.substring(nx, 1, 1).rlike(r"[\p{Ll}0]")
        kind = F.when(i == n - 1, F.when(dots, "d").otherwise("f")).when((nx == "\n") | (F.substring(w, -8, 8).rlike(CLOSED) & starts), "e").otherwise("c")
        before = lambda k: F.when(i >= k, F.get(t, i - k)).otherwise("^")
        return F.struct(before(2).alias("b"), before(1).alias("a"), w.alias("w"), kind.alias("kind"))

    def bare(x: Column) -> Column:
        w = F.when(x["kind"] == "e", _undotted(x["w"])).otherwise(x["w"])
        return F.struct(x["b"].alias("b"), x["a"].alias("a"), w.alias("w"), F.when(w != x["w"], "d").otherwise(x["kind"]).alias("kind"))

    return F.transform(F.filter(F.transform(t, one), lambda x: x["w"] != "\n"), bare)


def _evidence(stats: DataFrame, tails: DataFrame, keys: list[str]) -> DataFrame:
    """In one pass over stats, of the keys that tails have: by (keys, w) how often w is there as a strict
    prefix (l), goes on (c), ends a unit (e), a text (f) or either in dots (d), with k null; and by (keys, k)
    the same of all words of class k, with w null. Words are cut at the lengths asked for under the same
    keys only, so that each prefix is met by an equality."""
    lengths = tails.groupBy(*keys).agg(F.collect_set(F.length("w")).alias("_ls"))
    at = F.explode(F.concat(F.filter("_ls", lambda k: k <= F.length("w")), F.array(F.lit(None).cast("int"))))  # null: for the class
    met = stats.join(lengths, keys).select(*keys, "w", *"cefd", at.alias("_l"))
    strict = F.col("_l") < F.length("w")
    by = [F.expr("substring(w, 1, _l)").alias("w"), F.when(F.col("_l").isNull(), _class(F.col("w"))).alias("k")]
    longer = F.sum(F.when(strict, F.col("c") + F.col("e") + F.col("f") + F.col("d")).otherwise(0)).alias("l")
    return met.groupBy(*keys, *by).agg(longer, *[F.sum(F.when(strict, 0).otherwise(F.col(x))).alias(x) for x in "cefd"])


def prefixes_of_others(docs: DataFrame, key: str, text: str, record: str | None = None) -> DataFrame:
    """(key): rows whose text is a strict prefix of another row's text, with the same record if one is named."""
    x = docs.select(F.col(key).alias("_k"), F.col(text).alias("_x"), F.length(text).alias("_n"), (F.col(record) if record else F.lit(0)).alias("_r"))
    # the longest fixed length that fits the shorter text
    short = x.where(F.col("_n") >= GRID[0]).withColumn("_g", F.array_max(F.filter(F.array(*map(F.lit, GRID)), lambda g: g <= F.col("_n"))))
    short = short.select("_k", "_r", "_n", "_g", F.xxhash64(F.expr("substring(_x, 1, _g)")).alias("_h"), F.xxhash64("_x").alias("_whole"), F.xxhash64(F.lit(1), "_x").alias("_again"))
    grid = F.filter(F.array(*map(F.lit, GRID)), lambda g: g <= F.col("_n"))
    wanted = short.groupBy("_r", "_g", "_h").agg(F.collect_set("_n").alias("_ns"), F.min("_n").alias("_least"))
    ids = x.select(F.xxhash64("_x").alias("_id"), "_r", "_x", "_n")
    long = ids.select("_id", "_r", "_n", F.explode(F.transform(grid, lambda g: F.struct(g.alias("g"), F.xxhash64(F.col("_x").substr(F.lit(1), g)).alias("h")))).alias("p")).select("_id", "_r", "_n", F.col("p.g").alias("_g"), F.col("p.h").alias("_h"))
    near = long.join(wanted, ["_r", "_g", "_h"]).where("_n > _least").select("_id", "_r", F.filter("_ns", lambda k: k < F.col("_n")).alias("_ns")).distinct()
    long = ids.join(near, ["_id", "_r"]).select("_r", "_x", "_ns")  # only these texts travel
    cut = long.select("_r", "_x", F.explode("_ns").alias("_n")).withColumn("_p", F.expr("substring(_x, 1, _n)"))
    cut = cut.select("_r", "_n", F.xxhash64("_p").alias("_whole"), F.xxhash64(F.lit(1), "_p").alias("_again")).distinct()
    return short.join(cut, ["_r", "_n", "_whole", "_again"], "left_semi").select(F.col("_k").alias(key))


def truncated(docs: DataFrame, key: str = "doc_id", text: str = "text", record: tuple[str, ...] = ("label", "written_at")) -> DataFrame:
    """(key, reason) of the texts that stop before their end; reason is ``mark``, ``structure``,
    ``copy`` or ``phrase``. Null, empty and blank texts are no cases; keys are taken as unique; texts
    are read whole; an empty table gives no rows. Rows equal in all columns of record, where docs has them
    and none is null, are taken as copies of one record."""
    known = [F.col(c).isNotNull() for c in record] if record and set(record) <= set(docs.columns) else [F.lit(False)]
    one = F.when(reduce(and_, known), F.xxhash64(F.lit(2), *[c for c in record if c in docs.columns]))
    raw = docs.select(F.col(key).alias("_k"), trimmed(F.col(text)).alias("_x"), one.cast("long").alias("_r")).where("_x <> ''")
    alike = [F.xxhash64("_x").alias("_u"), F.xxhash64(F.lit(1), "_x").alias("_v")]
    once = Stage(raw.select("_x").distinct()).df.select("_x", *alike)  # copies of a text are no proof of each other
    end = F.substring("_x", -TAIL, TAIL)
    x = spread(once).withColumn("_s", F.when(end.rlike(DOTS), F.concat(F.expr(f"substring(_x, 1, greatest(length(_x) - {TAIL}, 0))"), _undotted(end))).otherwise(F.col("_x")))
    x = x.withColumn("_t", _tokens(F.col("_s"))).withColumn("_off", F.col("_s") != F.col("_x"))
    words = x.select(F.explode(F.array_distinct(_phrases(F.col("_t"), F.col("_off")))).alias("p"))  # once per text: no text outvotes the others
    words = words.select("p.*")
    n = lambda k: F.sum((F.col("kind") == k).cast("long")).alias(k)
    s2 = Stage(words.groupBy("b", "a", "w").agg(n("c"), n("e"), n("f"), n("d")))
    last = F.element_at(_phrases(F.slice("_t", -4, 4), F.col("_off")), -1)  # the texts are trimmed: the last token is a word
    last = F.when(F.size("_t") >= 4, last).otherwise(F.element_at(_phrases(F.col("_t"), F.col("_off")), -1))
    looks = {
        "_bullet": F.split_part(F.trim(F.element_at(F.split("_x", r"\n"), -1)), F.lit(" "), F.lit(1)).rlike(BULLET),
        "_closed": end.rlike(CLOSED), "_mark": end.rlike(MARK), "_dots": end.rlike(DOTS), "_off": F.col("_off"), "_json": F.col("_x").rlike(OPENS), "_opened": F.col("_x").rlike(OPENS) & ~end.rlike(SHUTS),
        "_more": F.col("_x").rlike(r"[.?!。！？][\"'”’)」]*+\s*+\S|\n"),
    }
    tails = x.where(F.size("_t") > 0).select("_u", "_v", last.alias("p"), F.size("_t").alias("_n"), *[e.alias(n) for n, e in looks.items()])
    tails = Stage(tails.select("_u", "_v", "p.b", "p.a", "p.w", _class(F.col("p.w")).alias("k"), F.lit(0).alias("z"), "_n", *looks)).df
    # level by level, each in plans of its own: all at once are more broadcasts and stages than a small driver holds
    total = [F.sum(k).alias(k) for k in "cefd"]
    seen2 = Stage(_evidence(s2.df, tails, ["b", "a"])).df
    s1 = Stage(s2.df.groupBy("a", "w").agg(*total))
    s2.drop()
    seen1 = Stage(_evidence(s1.df, tails, ["a"])).df
    seen0 = Stage(_evidence(s1.df.groupBy("w").agg(*total).withColumn("z", F.lit(0)), tails, ["z"])).df
    s1.drop()
    of_word = lambda seen, keys, tag: seen.where("k is null").select(*keys, "w", *[F.col(x).alias(f"{x}{tag}") for x in "lcefd"])
    of_class = lambda seen, keys, tag: seen.where("w is null").select(*keys, "k", F.col("c").alias(f"cw{tag}"), (F.col("e") + F.col("d")).alias(f"ew{tag}"), F.col("f").alias(f"fw{tag}"))
    judged = (  # each tail is a phrase of its own text, so its counts are there
        tails.join(of_word(seen2, ["b", "a"], "2"), ["b", "a", "w"])
        .join(of_word(seen1, ["a"], "1"), ["a", "w"])
        .join(of_word(seen0, ["z"], "0"), ["z", "w"])
        .join(of_class(seen2, ["b", "a"], "2"), ["b", "a", "k"])
        .join(of_class(seen1, ["a"], "1"), ["a", "k"])
    )
    v = F.col
    # ends of other texts, in dots if the text ends in dots; and how often the same words go on
    ends2, ends1, ends0 = [F.when(v("_off"), v(f"d{i}") - 1).otherwise(v(f"f{i}") - 1 + v(f"e{i}")) for i in (2, 1, 0)]
    goes2, goes1, goes0 = [v(f"l{i}") + v(f"c{i}") + F.when(v("_off"), 0).otherwise(v(f"d{i}")) for i in (2, 1, 0)]
    is_end = lambda ends, goes: (ends > 0) & (ends >= SHARE * goes)
    alone = v("_n") <= 3
    ended_w2 = v("fw2") - 1 + v("ew2")
    ended_w1 = v("fw1") - 1 + v("ew1")
    phrase = (
        F.when(v("_bullet"), (v("e0") == 0) & (goes0 > 0) & ~is_end(ends0, goes0))
        .when(is_end(ends2, goes2), False)
        .when((goes2 > 0) & (v("e2") == 0), True)
        .when(v("e2") > 0, v("e2") <= 0.05 * goes2)
        .when(alone, (v("l0") > 0) & (v("e0") + v("c0") == 0) & ~is_end(ends0, goes0))
        .when((v("cw2") >= 3) & (ended_w2 < 0.1 * v("cw2")), True)
        .when((ended_w2 >= 2) & (ended_w2 >= v("cw2")), False)
        .when((goes1 > 0) & (v("e1") == 0) & ~is_end(ends1, goes1) & ~v("_closed"), True)
        .when(v("e1") > 0, False)
        .when((v("cw1") >= 10) & (ended_w1 < 0.05 * v("cw1")) & ~v("_closed"), True)
        .when(v("_closed"), False)
        .otherwise((v("l0") > 0) & (v("e0") + v("c0") == 0) & ~is_end(ends0, goes0))
    )
    copies = prefixes_of_others(once.select(F.struct("_u", "_v").alias("_id"), "_x"), "_id", "_x")
    copies = Stage(copies.select("_id.*", F.lit(True).alias("_copy"))).df
    rows = Stage(raw.select("_k", "_r", *alike)).df
    records = rows.join(copies, ["_u", "_v"], "left_semi").where("_r is not null").select("_r").distinct()
    pool = Stage(rows.join(records, "_r", "left_semi").join(once, ["_u", "_v"]).select("_k", "_r", "_x")).df
    again = Stage(prefixes_of_others(pool, "_k", "_x", "_r").withColumn("_same", F.lit(True))).df
    reason = (
        F.when(v("_mark"), "mark")
        .when(v("_dots") & ~F.when(ends2 + goes2 > 0, is_end(ends2, goes2)).otherwise(is_end(ends1, goes1)), "mark")
        .when(v("_opened"), "structure")
        .when(v("_copy") & v("_more") & ~is_end(ends2, goes2), "copy")
        .when(~v("_dots") & ~v("_json") & phrase, "phrase")
    )
    verdict = Stage(judged.join(copies, ["_u", "_v"], "left").select("_u", "_v", reason.alias("reason")).where("reason is not null")).df
    found = rows.join(verdict, ["_u", "_v"], "left").join(again, "_k", "left")
    return found.select(v("_k").alias(key), F.coalesce("reason", F.when(v("_same"), "copy")).alias("reason")).where("reason is not null")


def by_source(docs: DataFrame, found: DataFrame, key: str = "doc_id", source: str = "source") -> DataFrame:
    """(source, n_docs, n_cut, share): how often each source truncates; a null source is one of its own."""
    hit = found.select(F.col(key), F.lit(1).alias("_hit"))
    rows = docs.select(key, source).join(hit, key, "left").groupBy(source).agg(F.count("*").alias("n_docs"), F.count("_hit").alias("n_cut"))
    return rows.select(source, "n_docs", "n_cut", (F.col("n_cut") / F.col("n_docs")).alias("share"))
