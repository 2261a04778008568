"""Unique username allocation as set operations.

The reference allocates one user at a time against the live table (so the
result depends on processing order and on earlier inserts being visible).
This is the deterministic set form; candidates are ordered by
``order_cols`` (unique), names are compared per mail domain:

1. base = sanitised override local part, else sanitised given+family name;
   alt  = sanitised given + middle initial + family (no override, middle set).
2. An override that is already taken, or repeats an earlier override, is
   rejected.
3. For each (domain, base) the first candidate takes the base if it is free;
   the others move to their alt when they have one, else need a suffix.
4. For each (domain, alt) the first candidate takes the alt if it is free;
   the others need a suffix on the alt.
5. Suffixes: the k-th candidate of a stem gets the k-th smallest positive
   integer s with stem||s free.  With the taken suffixes of the stem sorted
   t_1 < t_2 < …, the numbers below t_j that are free are t_j − j, so
   suffix(k) = k + #{j : t_j − j < k}.  That count is a running sum over
   (value, kind) order — no loop over candidates, no pairs.
6. Two stems can still meet (``ann1``+``1`` = ``ann``+``11``): clashing rows
   after the first are re-allocated against everything taken so far, round by
   round until everybody has a name.

Every step is a join, an aggregate or a range-partitioned numbering
(``sequence_within`` / ``cumulative_within``), so one hugely popular name is
spread over many tasks.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import initial_or_null, local_part, sanitize_username
from rollcall.operators.ranking import cumulative_within, join_back, materialize, sequence_within

_REJECT_TAKEN = "override taken"
_REJECT_DUP = "override repeated"
_REJECT_NAME = "no name"


def _mark(df: DataFrame, names: DataFrame, name_col: str, out: str) -> DataFrame:
    n = names.select(F.col("domain").alias("__d"), F.col("name").alias("__n")).distinct() \
        .withColumn("__hit", F.lit(True))
    j = df.join(n, (F.col("domain") == F.col("__d")) & (F.col(name_col) == F.col("__n")), "left")
    return j.withColumn(out, F.col("__hit").isNotNull()).drop("__d", "__n", "__hit")


def _first_flag(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str], out: str) -> DataFrame:
    """``out`` is true on the first row of each group in order (a partial
    aggregate of the minimum order key, joined back)."""
    mins = df.groupBy(*group_cols).agg(F.min(F.struct(*order_cols)).alias("__fmin"))
    return join_back(df, mins, group_cols).withColumn(
        out, F.struct(*order_cols) == F.col("__fmin")).drop("__fmin")


def _stem_suffixes(taken: DataFrame, stems: DataFrame) -> DataFrame:
    """(domain, stem, t) for every taken name stem||t, t without a leading 0."""
    digits = F.length(F.regexp_extract("name", r"([0-9]*)$", 1))
    splits = (taken.select("domain", "name", F.explode(F.sequence(F.lit(1), F.greatest(digits, F.lit(1)))).alias("__i"),
                           digits.alias("__nd"))
              .filter(F.col("__i") <= F.col("__nd"))
              .select("domain", F.expr("substring(name, 1, length(name) - __i)").alias("__stem"),
                      F.expr("substring(name, length(name) - __i + 1)").alias("__digits"))
              .filter(~F.col("__digits").startswith("0")))
    s = stems.select(F.col("domain").alias("__d"), F.col("__stem").alias("__s")).distinct()
    kept = splits.join(s, (F.col("domain") == F.col("__d")) & (F.col("__stem") == F.col("__s")), "left_semi")
    t = F.col("__digits").try_cast("bigint")
    return kept.filter(t.isNotNull()).select("domain", "__stem", t.alias("__t")).distinct()


def _suffix_round(need: DataFrame, taken: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """Assign the k-th free suffix of its stem to each row of ``need``.

    One numbering pass over the union of the stem's taken suffixes (first,
    ascending) and its candidates (after, in order) gives both ranks: j for a
    taken suffix, and k = rank − #taken for a candidate.
    """
    need = need.withColumn("__ord", F.struct(*order_cols))
    ord_type = need.schema["__ord"].dataType
    t = _stem_suffixes(taken, need.select("domain", "__stem"))
    both = (t.select("domain", "__stem", F.lit(0).alias("__kind"), "__t",
                     F.lit(None).cast(ord_type).alias("__ord"))
            .unionByName(need.select("domain", "__stem", F.lit(1).alias("__kind"),
                                     F.lit(None).cast("bigint").alias("__t"), "__ord")))
    both = sequence_within(both, ["domain", "__stem"], ["__kind", "__t", "__ord"], out="__r")
    m = (both.groupBy("domain", "__stem").agg(F.count(F.when(F.col("__kind") == 0, F.lit(1))).alias("__m"))
         .select(F.col("domain").alias("__md"), F.col("__stem").alias("__ms"), "__m"))
    both = both.join(m, (F.col("domain") == F.col("__md")) & (F.col("__stem") == F.col("__ms"))).drop("__md", "__ms")
    # events: candidate k (kind 0) sorts before a taken t_j − j equal to it (kind 1)
    ev = both.select(
        "__ord", "domain", "__stem",
        F.when(F.col("__kind") == 0, F.col("__t") - F.col("__r")).otherwise(F.col("__r") - F.col("__m")).alias("__v"),
        (F.lit(1) - F.col("__kind")).alias("__ek"), F.col("__r").alias("__tie"),
        (F.lit(1) - F.col("__kind")).alias("__flag"))
    ev = cumulative_within(ev, ["domain", "__stem"], ["__v", "__ek", "__tie"], F.col("__flag"), out="__before")
    sfx = ev.filter(F.col("__ek") == 0).select(F.col("__ord").alias("__o"),
                                               (F.col("__v") + F.col("__before")).alias("__suffix"))
    return (need.join(sfx, F.col("__ord") == F.col("__o")).drop("__o", "__ord")
            .withColumn("username", F.concat(F.col("__stem"), F.col("__suffix").cast("string"))))


def allocate_usernames(candidates: DataFrame, existing: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    """candidates: domain, given_name, family_name, middle_name, override, *order_cols
    existing:   domain, name (local parts already in use)

    Returns the candidates with ``username`` and ``reject_reason`` (one of
    them NULL).
    """
    c = candidates.withColumn("__base", F.when(F.col("override").isNotNull(), sanitize_username(local_part("override")))
                     .otherwise(sanitize_username(F.concat("given_name", "family_name"))))
    c = c.withColumn("__alt", F.when(F.col("override").isNull(),
                                   sanitize_username(F.concat("given_name", initial_or_null("middle_name"),
                                                              "family_name"))))
    ex = existing.select("domain", F.lower("name").alias("name"))
    no_name = F.col("__base").isNull() | (F.col("__base") == "")
    rejects = [c.filter(no_name).withColumn("username", F.lit(None).cast("string"))
               .withColumn("reject_reason", F.lit(_REJECT_NAME))]
    c = c.filter(~no_name)

    # (2) overrides
    o = _mark(c.filter(F.col("override").isNotNull()), ex, "__base", "__taken")
    o = materialize(_first_flag(o, ["domain", "__base"], order_cols, "__first"))
    o_ok = o.filter(~F.col("__taken") & F.col("__first"))
    rejects.append(o.filter(F.col("__taken")).withColumn("username", F.lit(None).cast("string"))
                   .withColumn("reject_reason", F.lit(_REJECT_TAKEN)))
    rejects.append(o.filter(~F.col("__taken") & ~F.col("__first")).withColumn("username", F.lit(None).cast("string"))
                   .withColumn("reject_reason", F.lit(_REJECT_DUP)))
    claims0 = o_ok.select("domain", F.col("__base").alias("name"))

    # (3) bases
    n = c.filter(F.col("override").isNull())
    n = _mark(n, ex.unionByName(claims0), "__base", "__taken")
    n = materialize(_first_flag(n, ["domain", "__base"], order_cols, "__first"))
    got_base = n.filter(~F.col("__taken") & F.col("__first"))
    rest = n.filter(F.col("__taken") | ~F.col("__first"))
    claims1 = got_base.select("domain", F.col("__base").alias("name"))

    # (4) alternates
    a = _mark(rest.filter(F.col("__alt").isNotNull()).drop("__taken", "__first"),
              ex.unionByName(claims0).unionByName(claims1), "__alt", "__taken")
    a = materialize(_first_flag(a, ["domain", "__alt"], order_cols, "__first"))
    got_alt = a.filter(~F.col("__taken") & F.col("__first"))
    claims2 = got_alt.select("domain", F.col("__alt").alias("name"))

    # (5) suffixes
    need = (rest.filter(F.col("__alt").isNull()).withColumn("__stem", F.col("__base"))
            .unionByName(a.filter(F.col("__taken") | ~F.col("__first")).withColumn("__stem", F.col("__alt")))
            .drop("__taken", "__first"))
    taken = ex.unionByName(claims0).unionByName(claims1).unionByName(claims2)
    done = [o_ok.withColumn("username", F.col("__base")), got_base.withColumn("username", F.col("__base")),
            got_alt.withColumn("username", F.col("__alt"))]
    keep_cols = [*candidates.columns, "username"]
    placed = [d.select(*keep_cols) for d in done]

    # (6) suffix rounds; rows whose name meets another stem's name go again, until
    # nobody is left (each round places at least one row per clashing name).
    while True:
        got = _suffix_round(need, taken, order_cols).select(*keep_cols, "__stem")
        ranked = materialize(_first_flag(got, ["domain", "username"], order_cols, "__won"))
        placed.append(ranked.filter(F.col("__won")).select(*keep_cols))
        need = ranked.filter(~F.col("__won")).drop("__won", "username")
        taken = taken.unionByName(ranked.filter(F.col("__won")).select("domain", F.col("username").alias("name")))
        if need.isEmpty():
            break

    ok = placed[0]
    for p in placed[1:]:
        ok = ok.unionByName(p)
    out = ok.withColumn("reject_reason", F.lit(None).cast("string"))
    for r in rejects:
        out = out.unionByName(r.select(*keep_cols, "reject_reason"))
    return out
