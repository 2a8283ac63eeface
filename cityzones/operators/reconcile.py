"""Reconciliation: map free-text names to canonical ids.

* ``build_lookup``   - district x neighbourhood lookup (explode + inner join).
* ``reconcile``      - raw rows -> canonical id by exact raw spelling, with an
                       explicit policy for rows that find no spelling.
* ``unmatched_keys`` - the spellings that found nothing, with row counts.
* ``reconcile_names``- fuzzy matching of distinct names against a canonical
                       table: exact on a normalised key first, then Levenshtein
                       within a parent block, exact and without any cap on
                       candidates: by deletion variants for a fixed number of
                       edits (``_deletion_variants``), by an index of rare
                       q-grams for a share of the length (``_rare_grams``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityzones.functions.checks import fail_if
from cityzones.functions.text import normalize_name, remove_char
from cityzones.operators.joins import join_measured
from cityzones.schemas import LOOKUP_COLUMNS
from cityzones.session import cut_lineage
from cityzones.session import materialize as shared

POLICIES = ("error", "drop", "keep")


def build_lookup(districts: DataFrame, neighborhoods: DataFrame) -> DataFrame:
    """Explode each district's neighbourhood-id array and inner-join the
    neighbourhoods on id.  Inputs use the income lookup field names (rent
    lookups are renamed on read).  Literal double quotes are removed from every
    text field; the id is kept as is."""
    d = districts.select(
        F.explode("neighborhood_id").alias("neighborhood_id"),
        F.col("_id").alias("district_id"), "district", "district_name", "district_reconciled",
    )
    n = neighborhoods.select(
        F.col("_id").alias("neighborhood_id"),
        "neighborhood", "neighborhood_name", "neighborhood_reconciled",
    )
    joined = d.join(n, "neighborhood_id", "inner")
    return joined.select(
        "neighborhood_id",
        *[remove_char(c).alias(c) for c in LOOKUP_COLUMNS[1:]],
    )


def reconcile(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str = "neighborhood",
              lookup_id: str = "neighborhood_id", out: str = "neighborhood_id",
              on_unmatched: str = "error") -> DataFrame:
    """Append ``out`` = the lookup id of the row's raw spelling ``df[key]``.

    on_unmatched: ``error`` fails the job at the first row without a spelling
    (raised from inside the id column); ``drop`` removes such rows (inner
    join); ``keep`` keeps them with a null id.

    A spelling may stand in several lookup rows (one per district spelling, or
    without an id in some): it is one key with the id they agree on, so no row
    of ``df`` is multiplied.  A row whose spelling has two different ids fails
    the job.  The lookup is joined by its measured size
    (``operators.joins.join_measured``)."""
    if on_unmatched not in POLICIES:
        raise ValueError(f"on_unmatched must be one of {POLICIES}")
    lk = (lookup.where(F.col(lookup_key).isNotNull())
          .groupBy(F.col(lookup_key).alias("_lk_key"))
          .agg(F.min(lookup_id).alias("_lk_id"), F.max(lookup_id).alias("_lk_max"),
               F.lit(True).alias("_lk_hit")))
    how = "inner" if on_unmatched == "drop" else "left"
    joined = join_measured(df, lk, [key], ["_lk_key"], how)
    ident: Column = fail_if(F.col("_lk_id") != F.col("_lk_max"), "_lk_id",
                            f"reconcile: the lookup has two ids for a value of {key}")
    if on_unmatched == "error":
        ident = fail_if(F.col("_lk_hit").isNull(), ident,
                        f"reconcile: a value of {key} has no entry in the lookup")
    return joined.select(*[df[c] for c in df.columns], ident.alias(out))


def unmatched_keys(df: DataFrame, lookup: DataFrame, key: str,
                   lookup_key: str = "neighborhood", out_count: str = "rows") -> DataFrame:
    """Raw spellings of ``df[key]`` absent from the lookup, with their row counts.

    Rows are counted per spelling before the lookup is looked at, so only one
    row per spelling and task is shuffled."""
    lk = lookup.select(F.col(lookup_key).alias("_lk_key")).distinct()
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(out_count))
    return counts.join(lk, counts[key] == lk["_lk_key"], "left_anti")


def _delete_one(arr: Column) -> Column:
    """Every string obtained by deleting exactly one character of an element."""
    def variants(v):
        n = F.length(v)
        return F.when(n > 0, F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.concat(F.substr(v, F.lit(1), i - 1), F.substr(v, i + 1)),
        )).otherwise(F.array().cast("array<string>"))
    return F.flatten(F.transform(arr, variants))


def _deletion_variants(col: Column, k: int) -> Column:
    """All strings reachable from ``col`` by deleting at most ``k`` characters.

    Two strings within Levenshtein distance k always share such a variant (a
    substitution is one deletion on each side, an insertion one deletion on
    the other), so an equi-join on variants finds every pair within distance
    k without comparing all pairs of a block.  Each level is bound once (as a
    lambda variable) so the expression stays linear in k."""
    variants = F.array(col)
    for _ in range(k):
        variants = F.get(F.transform(
            F.array(variants), lambda a: F.array_distinct(F.concat(a, _delete_one(a)))), 0)
    return variants


def _budget(longer: Column, percent: int) -> Column:
    """Edits allowed between two names, the longer of which has ``longer`` characters."""
    return F.floor(longer * percent / 100).cast("int")


def _grams(text: Column, q: int) -> Column:
    """Array of (gram, pos): all ``q`` neighbouring characters of ``text`` with ``q - 1`` marks on either side."""
    marked = F.concat(F.lit("^" * (q - 1)), text, F.lit("$" * (q - 1)))
    return F.transform(F.sequence(F.lit(1), F.length(text) + (q - 1)),
                       lambda i: F.struct(F.substr(marked, i, F.lit(q)).alias("gram"), i.alias("pos")))


def _rare_grams(df: DataFrame, text: str, rarity: DataFrame, percent: int, q: int) -> DataFrame:
    """The rows of ``df`` once for each (``_gram``, ``_pos``) they are found by: their rarest q-grams.

    An edit changes at most q grams of a name.  Of two names within d edits, q * d + 1 grams of either therefore hold
    one that the other has too, at most d places away; with the grams of both in one order, the first q * d + 1 of
    each (and what ties with the last) share it.  The order is by rarity, so the shared gram is in few names.  d is the
    budget of the longest name that this one can still match."""
    longest = F.floor(F.length(text) * 100 / (100 - percent))
    first = _budget(longest, percent) * q + 1
    each = df.withColumn("_g", F.explode(_grams(F.col(text), q))).select(*df.columns, "_g.gram", "_g.pos")
    ranked = each.join(rarity, "gram", "left")
    lists = ranked.groupBy(*df.columns).agg(F.array_sort(F.collect_set(F.struct(
        F.coalesce("uses", F.lit(0)).alias("uses"), "gram", "pos"))).alias("_l"))
    last = F.element_at("_l", F.least(F.size("_l"), first))
    kept = F.filter("_l", lambda x: F.struct(x["uses"], x["gram"]) <= F.struct(last["uses"], last["gram"]))
    return lists.withColumn("_x", F.explode(kept)).select(
        *df.columns, F.col("_x.gram").alias("_gram"), F.col("_x.pos").alias("_pos"))


def within_percent(names: DataFrame, canon: DataFrame, percent: int, q: int = 2) -> DataFrame:
    """Pairs of ``names`` (``_blk``, ``_n`` and others) and ``canon`` (``_cblk``, ``_cn`` and others) of one block that
    are at most ``percent`` % of the longer one's characters apart, with their distance ``_d``; a pair may come several
    times, once for each gram that found it.

    Candidates come from an inverted index of q-grams in the order of their rarity among the canonical names; place
    and length must fit before the distance is computed.  Nothing is capped.  ``percent`` is at most 100 / q: beyond
    it two names may match that share no gram."""
    if not 0 <= percent * q <= 100:
        raise ValueError(f"max_percent must be from 0 to {100 // q} with grams of {q}")
    rarity = shared(canon.select(F.explode(_grams(F.col("_cn"), q)).alias("g")).groupBy(F.col("g.gram").alias("gram"))
                    .agg(F.count(F.lit(1)).alias("uses")), "gram-uses")
    left = _rare_grams(names, "_n", rarity, percent, q)
    right = _rare_grams(canon, "_cn", rarity, percent, q).withColumnsRenamed({"_gram": "_cgram", "_pos": "_cpos"})
    longer = F.greatest(F.length("_n"), F.length("_cn"))
    most = _budget(longer, percent)
    fits = ((left["_blk"] == right["_cblk"]) & (F.col("_gram") == F.col("_cgram"))
            & (F.abs(F.col("_pos") - F.col("_cpos")) <= most)
            & (F.abs(F.length("_n") - F.length("_cn")) <= most))
    return (left.join(right, fits).withColumn("_d", F.levenshtein("_n", "_cn")).where(F.col("_d") <= most)
            .drop("_gram", "_pos", "_cgram", "_cpos"))


def reconcile_names(names: DataFrame, canon: DataFrame, name: str, canon_id: str, canon_name: str,
                    parent: str | None = None, canon_parent: str | None = None,
                    max_distance: int = 2, out_id: str = "id", out_name: str = "name_reconciled",
                    out_distance: str = "distance", materialize: bool = True,
                    max_percent: int | None = None) -> DataFrame:
    """Best canonical entry for every distinct (name, parent) of ``names``.

    Names and canonical names are compared on ``normalize_name``.  Candidates
    must share the parent (when given) and be within ``max_distance`` edits;
    the best has the smallest distance, then the smallest id.  Names without a
    candidate are kept with null id.  Output columns: name, parent (if any),
    ``out_id``, ``out_name``, ``out_distance``.

    ``materialize`` checkpoints the distinct names (an eager job) so the input
    is scanned once; the distinct set is bounded by the spelling variety,
    not by the row count.

    Cost: a normalised name of length L has at most C(L, 0) + ... + C(L, k)
    deletion variants (about 200 for L = 20, k = 2), generated only for names
    without an exact match and once per canonical entry; the variant join is
    an equi-join, so its work is linear in the variants, not quadratic in the
    names of a block.

    ``max_percent`` allows edits in proportion to the longer name's length
    instead of ``max_distance`` (variants grow with the power of the edits;
    the q-gram index of ``within_percent`` does not)."""
    block = F.col(parent) if parent else F.lit("")
    cblock = F.col(canon_parent) if canon_parent else F.lit("")
    keys = [name] + ([parent] if parent else [])

    # The distinct names are used four times below; materialise them once in
    # the reliable checkpoint folder so the (large) raw input is scanned once.
    src = (names.where(F.col(name).isNotNull()).select(*keys).distinct()
           .withColumn("_blk", block.cast("string"))
           .withColumn("_n", normalize_name(name)))
    if materialize:
        src = cut_lineage(src)
    cn = (canon.select(F.col(canon_id).alias("_cid"), F.col(canon_name).alias("_cname"),
                       cblock.cast("string").alias("_cblk"))
          .withColumn("_cn", normalize_name("_cname")))

    # 1. exact on the normalised key.
    exact = (src.join(cn, (src["_blk"] == cn["_cblk"]) & (src["_n"] == cn["_cn"]))
             .select(*keys, F.lit(0).alias("_d"), "_cid", "_cname"))
    # 2. the rest: candidates sharing a deletion variant, verified by distance.
    rest = src.join(exact.select(*keys).distinct(), keys, "left_anti")
    candidates = exact
    if max_percent is not None:
        # of canonical rows alike in block and normalised name only the first can be the best
        first = (cn.where(F.col("_cn").isNotNull()).groupBy("_cblk", "_cn")
                 .agg(F.min(F.struct("_cid", "_cname")).alias("_c")).select("_cblk", "_cn", "_c.*"))
        fuzzy = within_percent(rest, first, max_percent).select(*keys, "_d", "_cid", "_cname")
        candidates = exact.unionByName(fuzzy)
    elif max_distance > 0:
        rv = rest.select(*keys, "_blk", "_n",
                         F.explode(_deletion_variants(F.col("_n"), max_distance)).alias("_v"))
        cv = cn.select("_cid", "_cname", "_cblk", "_cn",
                       F.explode(_deletion_variants(F.col("_cn"), max_distance)).alias("_v"))
        pairs = (rv.join(cv, (rv["_blk"] == cv["_cblk"]) & (rv["_v"] == cv["_v"]))
                 .select(*keys, "_n", "_cn", "_cid", "_cname").distinct())
        fuzzy = (pairs.withColumn("_d", F.levenshtein("_n", "_cn"))
                 .where(F.col("_d") <= max_distance)
                 .select(*keys, "_d", "_cid", "_cname"))
        candidates = exact.unionByName(fuzzy)

    best = (candidates.groupBy(*keys)
            .agg(F.min(F.struct("_d", "_cid", "_cname")).alias("_b"))
            .select(*keys, "_b._d", "_b._cid", "_b._cname"))
    return (src.select(*keys).join(best, keys, "left")
            .select(*keys, F.col("_cid").alias(out_id), F.col("_cname").alias(out_name),
                    F.col("_d").alias(out_distance)))
