"""Greedy leader deduplication, duplicate groups and index lookup.

Greedy semantics (the reference's sequential loop): items are visited in order;
each is compared with the current leaders only; if any matches, the item is a
duplicate of the best-scoring leader (ties: the earliest leader), otherwise it
becomes a leader. The relation is not transitive: A~B, B~C, A!~C gives leaders
A and C.

Distributed form, on edges verified once:

1. Exact copies are collapsed first (group by the compared signature): every
   copy but the first is a duplicate, so only one representative per distinct
   signature goes on. A third of the corpus sharing one signature is one
   group-by with map-side combine.
2. Band keys that more than one representative holds are written. If one of
   them has more than ``small_bucket`` holders, the earliest holders thin it
   out first (``thin_hot_keys``): a cluster of near copies never becomes a list
   of all its pairs.
   The exact embedding join has no keys: its candidates come from the pivot cells, and
   ``thin_near_copies`` thins out groups of near copies by its own exact matches.
3. The candidates left are verified once into a table of edges (earlier, later,
   score). Rounds over that table decide the items: with an earlier leader a
   duplicate, with no earlier undecided neighbour a leader. Only true matches
   count, so the rounds follow the chains of true matches. Each round reads the
   edges and one state table and writes the next one: plans stay flat.
4. Assignment: each duplicate takes the best match over all leaders earlier
   than itself (struct(badness, leader order) minimum).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediasift.operators.metric_join import ExactEmbeddingSpec
from mediasift.operators.simjoin import BLOCK, Spec, candidate_pairs, shared_keys, verify_pairs, with_holders, written

OUT_COLS = ["video_id", "primary_id", "score", "is_unique"]


def _order(df: DataFrame, id_col: str, order_col: str | None):
    """Adds ``ord``: a comparable, unique visiting order (order column, then id)."""
    if order_col is None or order_col == id_col:
        return df.withColumn("ord", F.struct(F.col(id_col).alias("o"), F.col(id_col).alias("i")))
    return df.withColumn("ord", F.struct(F.col(order_col).alias("o"), F.col(id_col).alias("i")))


def _has_signature(spec: Spec):
    """A signature with an unreadable (null) frame is no signature."""
    sig = F.col(spec.sig_col)
    return sig.isNotNull() & ~F.coalesce(F.exists(sig, lambda x: x.isNull()), F.lit(False))


def prepare_items(sigs: DataFrame, spec: Spec, id_col: str = "video_id",
                  order_col: str | None = None, missing: bool = False) -> DataFrame:
    """(id, ord, sig, nf, self_match) for rows with a non-null signature; with ``missing`` for all rows, ``sig``
    null where there is none."""
    items = _order(sigs, id_col, order_col).withColumnRenamed(id_col, "id")
    if missing:
        items = items.withColumn(spec.sig_col, F.when(_has_signature(spec), F.col(spec.sig_col)))
    else:
        items = items.where(_has_signature(spec))
    return spec.prepare(items).select("id", "ord", "sig", "nf", "self_match")


def collapse_copies(items: DataFrame):
    """Split self-matching items into representatives and copies.

    Returns (reps[id, ord, sig, nf], copies[id, ord, rep_id]). Only signatures
    with copies are joined back, to a written table, so AQE can split a hot one.
    """
    groups = written(items.where("self_match").groupBy("sig")
                     .agg(F.min(F.struct("ord", "id")).alias("r"), F.first("nf").alias("nf"),
                          F.count(F.lit(1)).alias("n")), "signatures")
    reps = groups.select(F.col("r.id").alias("id"), F.col("r.ord").alias("ord"), "sig", "nf")
    copied = groups.where("n > 1").select("sig", F.col("r.id").alias("rep_id"))
    copies = (items.where("self_match").join(copied, "sig").where(F.col("id") != F.col("rep_id"))
              .select("id", "ord", "rep_id"))
    return reps, copies


SMALL_BUCKET = 64      # more holders of one key start the thinning
WORTHWHILE = 0.1       # a thinning round that decides less of the items is the last


def thin_hot_keys(keys: DataFrame, reps: DataFrame, spec: Spec, small_bucket: int):
    """Decide by earliest holders while some key has over ``small_bucket`` holders.

    An item with no earlier holder in any of its keys is a leader; the items of
    its keys that match it are duplicates (one candidate per item and key, no
    pairs among the holders). Both leave the keys. An item that leaves as a
    leader matches nothing that stays, so the edges of the rest are complete.
    Stops when a round decides under ``WORTHWHILE`` of the items; where it stops
    changes the work, not the result. Returns (keys left, duplicates[id]).
    """
    order = reps.select("id", "ord")
    dups = keys.select("id").limit(0)
    while True:
        top = keys.agg(F.max("n"), F.approx_count_distinct("id")).first()
        if (top[0] or 0) <= small_bucket:
            return keys, dups
        held = keys.join(order, "id")
        firsts = written(held.where("is_index").groupBy("key").agg(F.min(F.struct("ord", "id")).alias("m"))
                         .select("key", F.col("m.ord").alias("lord"), F.col("m.id").alias("a")), "firsts")
        near = written(held.where("is_probe").join(firsts, "key").where(F.col("lord") < F.col("ord"))
                       .select("a", F.col("id").alias("b")).distinct(), "near")
        leaders = keys.select("id").distinct().join(near.select(F.col("b").alias("id")), "id", "left_anti")
        found = verify_pairs(near.join(leaders.select(F.col("id").alias("a")), "a", "left_semi"),
                             reps.select("id", "sig"), spec)
        decided = written(found.select(F.col("b").alias("id")).distinct().withColumn("dup", F.lit(True))
                          .unionByName(leaders.withColumn("dup", F.lit(False))), "thinned")
        dups = dups.unionByName(decided.where("dup").select("id"))
        keys = with_holders(keys.join(decided.select("id"), "id", "left_anti"), "keys")
        if decided.count() < WORTHWHILE * top[1]:
            return keys, dups


FIRSTS = 1024          # earliest holders that one round of the exact join tries


def thin_near_copies(reps: DataFrame, spec: ExactEmbeddingSpec, small_bucket: int):
    """As ``thin_hot_keys`` for the exact join: decide by the earliest holders of large hashing buckets.

    The buckets only say whom to try. A tried item without any earlier match among the items left is a leader,
    its later matches are duplicates, and both leave; the matches come from the exact join. So no list of all
    pairs of a group of near copies is made, and what the hashing misses is no loss. Returns (items left,
    duplicates[id]).
    """
    dups = reps.select("id").limit(0)
    keys = shared_keys(reps, spec, "thin-keys")
    while True:
        hot = keys.where(F.col("n") > small_bucket).join(reps.select("id", "ord"), "id")
        firsts = hot.groupBy("key").agg(F.min(F.struct("ord", "id")).alias("m")).select("m.ord", "m.id").distinct()
        firsts = written(firsts.orderBy("ord").limit(FIRSTS).select("id", F.lit(True).alias("is_index")), "tried")
        if firsts.isEmpty():
            return reps, dups
        asked = (reps.join(F.broadcast(firsts), "id", "left").na.fill(False, ["is_index"]).withColumn("is_probe", F.lit(True)))
        ord_of = reps.select("id", "ord")
        found = (verify_pairs(spec.candidates(asked), reps.select("id", "sig"), spec)
                 .join(ord_of.select(F.col("id").alias("a"), F.col("ord").alias("_oa")), "a")
                 .join(ord_of.select(F.col("id").alias("b"), F.col("ord").alias("_ob")), "b"))
        first = F.col("_oa") < F.col("_ob")
        near = written(found.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("a"),
                                    F.when(first, F.col("b")).otherwise(F.col("a")).alias("b")), "near")
        leaders = firsts.select("id").join(near.select(F.col("b").alias("id")), "id", "left_anti")
        led = near.join(leaders.select(F.col("id").alias("a")), "a", "left_semi").select(F.col("b").alias("id")).distinct()
        decided = written(led.withColumn("dup", F.lit(True)).unionByName(leaders.withColumn("dup", F.lit(False))), "thinned")
        dups = dups.unionByName(decided.where("dup").select("id"))
        few = decided.count() < WORTHWHILE * reps.count()
        reps = written(reps.join(decided.select("id"), "id", "left_anti"), "left")
        if few:
            return reps, dups
        keys = with_holders(keys.join(decided.select("id"), "id", "left_anti"), "thin-keys")


def greedy_rounds(edges: DataFrame) -> DataFrame:
    """Duplicates (id) of the greedy loop over written ``edges`` (a earlier, b later).

    An item that is never the later end is a leader. Each round is one join, one
    group-by and one state table in the shared checkpoint folder (a lost
    executor repeats only this round).
    """
    state = written(edges.select(F.col("b").alias("id")).distinct()
                    .select("id", F.lit("open").alias("state")), "state")
    while not state.where("state = 'open'").isEmpty():
        live = edges.select("a", "b").join(state.where("state = 'open'").select(F.col("id").alias("b")), "b")
        seen = (live.join(state.select(F.col("id").alias("a"), "state"), "a", "left")
                .groupBy(F.col("b").alias("id"))
                .agg(F.max(F.coalesce("state", F.lit("leader")) == "leader").alias("led"),
                     F.max(F.coalesce("state", F.lit("leader")) == "open").alias("waits")))
        state = written(state.join(seen, "id", "left").select(
            "id", F.when(F.col("state") != "open", F.col("state")).when(F.col("led"), "dup")
            .when(F.col("waits"), "open").otherwise("leader").alias("state")), "state")
    return state.where("state = 'dup'").select("id")


def greedy_leaders(sigs: DataFrame, spec: Spec, id_col: str = "video_id",
                   order_col: str | None = None, on_missing: str = "keep",
                   small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """Greedy near-duplicate assignment: (video_id, primary_id, score, is_unique).

    Leaders have ``primary_id = video_id`` and a NULL score. ``on_missing``
    decides whether items with a NULL signature are kept as unique ("keep") or
    dropped ("drop").
    """
    if on_missing not in ("keep", "drop"):
        raise ValueError("on_missing must be 'keep' or 'drop'")
    # All rows are written, those without a signature too: ``sigs`` may be hours of hashing and is read once.
    every = written(prepare_items(sigs, spec, id_col, order_col, missing=True), "items")
    items = every.where("sig IS NOT NULL")

    # Items that cannot match anything: empty, or (embeddings) too many zero frames.
    lonely = items.where(~F.col("self_match")).select("id")
    reps, copies = collapse_copies(items)
    sig_of, ord_of = reps.select("id", "sig"), reps.select("id", "ord")
    exact = isinstance(spec, ExactEmbeddingSpec)
    if exact:
        rest, thinned = thin_near_copies(reps, spec, small_bucket)
        pairs = spec.candidates(rest)
    else:
        keys = shared_keys(reps, spec)
        rest, thinned = thin_hot_keys(keys, reps, spec, small_bucket)
        pairs = candidate_pairs(rest.where("is_index"), rest.where("is_probe")).where(F.col("a") < F.col("b"))
    found = (verify_pairs(pairs, sig_of, spec)
             .join(ord_of.select(F.col("id").alias("a"), F.col("ord").alias("_oa")), "a")
             .join(ord_of.select(F.col("id").alias("b"), F.col("ord").alias("_ob")), "b"))
    first = F.col("_oa") < F.col("_ob")
    edges = written(found.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("a"),
                                 F.when(first, F.col("b")).otherwise(F.col("a")).alias("b"), "score"), "edges")
    dups = written(thinned.unionByName(greedy_rounds(edges)), "dups")
    leaders = reps.select("id", "ord").join(dups, "id", "left_anti").hint("merge")

    # Scored (d, leader) pairs: the edges between a duplicate and a leader, and for
    # the duplicates found by thinning the leaders that hold one of their keys (exact join: all leaders).
    both = (edges.select(F.col("a").alias("lid"), F.col("b").alias("d"), "score")
            .unionByName(edges.select(F.col("b").alias("lid"), F.col("a").alias("d"), "score"))
            .join(dups.select(F.col("id").alias("d")), "d", "left_semi"))
    if exact:
        lead = reps.join(leaders.select("id", F.lit(True).alias("is_index")), "id", "left").join(
            thinned.select("id", F.lit(True).alias("is_probe")), "id", "left").na.fill(False, ["is_index", "is_probe"])
        late = spec.candidates(lead) if not thinned.isEmpty() else pairs.limit(0)
        late = late.join(thinned.withColumnRenamed("id", "a"), "a", "left_anti").unionByName(
            late.join(thinned.select(F.col("id").alias("a")), "a").select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        late = candidate_pairs(keys.where("is_index").join(leaders.select("id"), "id", "left_semi"),
                               keys.where("is_probe").join(thinned, "id", "left_semi"))
    late = verify_pairs(late, sig_of, spec).select(F.col("a").alias("lid"), F.col("b").alias("d"), "score")
    scored = both.unionByName(late).join(leaders.select(F.col("id").alias("lid"), F.col("ord").alias("lord")), "lid")

    # Copies: the representative's status decides theirs.
    copies_s = copies.join(dups.select(F.col("id").alias("rep_id"), F.lit(True).alias("dup")), "rep_id", "left")
    assignees = (reps.select("id", "ord").join(dups, "id").select("id", "ord", F.col("id").alias("d"))
                 .unionByName(copies_s.where("dup").select("id", "ord", F.col("rep_id").alias("d"))))
    best = (assignees.join(scored.hint("merge"), "d").where(F.col("lord") < F.col("ord"))
            .groupBy("id").agg(F.min(F.struct(spec.badness(F.col("score")).alias("bad"),
                                              "lord", "lid", "score")).alias("m"))
            .select(F.col("id").alias("video_id"), F.col("m.lid").alias("primary_id"),
                    F.col("m.score").cast("double").alias("score"), F.lit(False).alias("is_unique")))

    self_score = reps.select(F.col("id").alias("rep_id"), spec.score(F.col("sig"), F.col("sig")).alias("ss"))
    copies_out = copies_s.where("dup IS NULL").join(self_score, "rep_id").select(
        F.col("id").alias("video_id"), F.col("rep_id").alias("primary_id"),
        F.col("ss").cast("double").alias("score"), F.lit(False).alias("is_unique"))

    unique_ids = leaders.select("id").unionByName(lonely)
    if on_missing == "keep":
        unique_ids = unique_ids.unionByName(every.where("sig IS NULL").select("id"))
    uniques = unique_ids.select(F.col("id").alias("video_id"), F.col("id").alias("primary_id"),
                                F.lit(None).cast("double").alias("score"), F.lit(True).alias("is_unique"))
    return uniques.unionByName(best).unionByName(copies_out).select(*OUT_COLS)


def similarity_pairs(sigs: DataFrame, spec: Spec, id_col: str = "video_id", every_copy: bool = False) -> DataFrame:
    """Matching pairs (id_a < id_b, score).

    Between distinct signatures every pair of representatives (the smallest id of
    a signature); and one pair (representative, copy) for each exact copy, so a
    signature shared by a third of the corpus is linear in the list, and no
    matching item is missing from it. With ``every_copy`` all matching pairs of
    items, those of copies too: the list grows with the square of a signature's
    copies. Candidates come from the band-key equi-join, never from a cross join.
    """
    items = written(prepare_items(sigs, spec, id_col).where("self_match"), "items")
    reps, copies = collapse_copies(items)
    itself = reps.select(F.col("id").alias("rep_id"), spec.score(F.col("sig"), F.col("sig")).alias("score"))
    found = matching_pairs(reps, spec)
    if every_copy:
        found = _pairs_of_copies(written(found, "matches"), written(copies.select("rep_id", "id"), "copies"), itself)
    else:
        same = copies.join(itself, "rep_id").select(F.col("rep_id").alias("a"), F.col("id").alias("b"), "score")
        found = found.unionByName(same)
    return found.select(F.col("a").alias("id_a"), F.col("b").alias("id_b"), F.col("score").cast("double").alias("score"))


def _pairs_of_copies(matches: DataFrame, copies: DataFrame, itself: DataFrame) -> DataFrame:
    """(a < b, score) of all items whose representatives are equal or match.

    ``matches``: written (a, b, score) of representatives; ``copies``: written (rep_id, id) without these;
    ``itself``: (rep_id, score) of a representative with itself. The items of two representatives are dealt out
    in blocks as in ``candidate_pairs``, so no task holds all pairs of a large group.
    """
    sizes = written(copies.groupBy("rep_id").agg((F.count(F.lit(1)) + 1).alias("n")), "copied")
    size_of = lambda side: sizes.select(F.col("rep_id").alias(side), F.col("n").alias("n" + side))
    sized = written(matches.join(size_of("a"), "a", "left").join(size_of("b"), "b", "left").na.fill(1, ["na", "nb"])
                    .select("a", "b", "score", "na", "nb"), "sized-matches")
    single = F.greatest("na", "nb") == 1
    own = itself.join(sizes, "rep_id").select(F.col("rep_id").alias("a"), F.col("rep_id").alias("b"), "score",
                                              F.col("n").alias("na"), F.col("n").alias("nb"))
    links = written(sized.where(~single).unionByName(own), "links-of-copies")
    members = copies.unionByName(sizes.select("rep_id", F.col("rep_id").alias("id")))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    x, y = F.coalesce("id", "a"), F.coalesce("id", "b")
    dealt = lambda item, n: F.pmod(F.xxhash64(item), blocks(n)).cast("int")
    left = links.join(members.withColumnRenamed("rep_id", "a"), "a", "left").select(
        "a", "b", "score", x.alias("x"), dealt(x, "na").alias("i"), every("nb").alias("j"))
    right = links.join(members.withColumnRenamed("rep_id", "b"), "b", "left").select(
        "a", "b", y.alias("y"), every("na").alias("i"), dealt(y, "nb").alias("j"))
    pairs = left.hint("merge").join(right, ["a", "b", "i", "j"]).where((F.col("a") != F.col("b")) | (F.col("x") < F.col("y")))
    return sized.where(single).select("a", "b", "score").unionByName(
        pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "score"))


def matching_pairs(items: DataFrame, spec: Spec) -> DataFrame:
    """(a < b, score) of all matching written ``items`` (id, sig, nf)."""
    if isinstance(spec, ExactEmbeddingSpec):
        cands = spec.candidates(items)
    else:
        keys = shared_keys(items, spec)
        cands = candidate_pairs(keys.where("is_index"), keys.where("is_probe")).where(F.col("a") < F.col("b"))
    return verify_pairs(cands, items.select("id", "sig"), spec).select("a", "b", "score")


def fused_matches(first: DataFrame, first_spec: Spec, second: DataFrame, second_spec: Spec,
                  id_col: str = "video_id") -> DataFrame:
    """Pairs that match in both modalities: (id_a < id_b, first_score, second_score).

    Items equal in both are copies: one pair with their smallest id each. All
    others stay apart although one modality is equal: the second modality gives
    the candidates, and both scores are taken on each, so no pair is lost to a
    collapse in one modality only.
    """
    a = prepare_items(first, first_spec, id_col).where("self_match").select("id", F.col("sig").alias("_first"))
    both = a.hint("merge").join(prepare_items(second, second_spec, id_col).where("self_match").select("id", "sig", "nf"), "id")
    reps = written(both.groupBy("_first", "sig").agg(F.min("id").alias("id"), F.first("nf").alias("nf")), "fused")
    left, right = (reps.select(F.col("id").alias(n), F.col("_first").alias("_" + n)) for n in "ab")
    near = (matching_pairs(reps.select("id", "sig", "nf"), second_spec).withColumnRenamed("score", "second")
            .join(left, "a").join(right, "b").where(first_spec.comparable(F.col("_a"), F.col("_b")))
            .select("a", "b", "second", F.explode(F.array(first_spec.score(F.col("_a"), F.col("_b")))).alias("first"))
            .where(first_spec.is_match(F.col("first"))))
    same = (both.join(reps.select(F.col("id").alias("a"), "_first", "sig"), ["_first", "sig"]).where(F.col("id") != F.col("a"))
            .select("a", F.col("id").alias("b"), second_spec.score(F.col("sig"), F.col("sig")).alias("second"),
                    first_spec.score(F.col("_first"), F.col("_first")).alias("first")))
    return near.unionByName(same).select(F.col("a").alias("id_a"), F.col("b").alias("id_b"),
                                         F.col("first").cast("double").alias("first_score"),
                                         F.col("second").cast("double").alias("second_score"))


def lookup_index(probes: DataFrame, index: DataFrame, spec: Spec, id_col: str = "video_id") -> DataFrame:
    """Nearest index entry within the threshold for every probe.

    Returns (probe_id, match_id, score); probes without a match get NULLs.
    Ties go to the smallest index id. Identical index signatures tie exactly, so
    the index is cut to its smallest id per signature before the band join, and
    identical probes share one answer: a signature held by a third of either
    side costs one aggregation, not a pair list.
    """
    p = written(prepare_items(probes, spec, id_col), "probes")
    i = prepare_items(index, spec, id_col).where("self_match")
    i = written(i.groupBy("sig").agg(F.min("id").alias("id")), "index")
    pu = written(p.groupBy("sig").agg(F.min("id").alias("rep")), "probe_reps")
    ix = spec.index_keys(i.select("id", "sig", F.size("sig").alias("nf")))
    held = written(ix.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "index_sizes")
    pb = spec.probe_keys(pu.select(F.col("rep").alias("id"), "sig", F.size("sig").alias("nf"))).join(held.hint("merge"), "key")  # as in with_holders
    pb = written(pb, "probe_keys")
    cands = candidate_pairs(ix.join(held.hint("merge"), "key"), pb, distinct_items=False)
    sa = i.select(F.col("id").alias("a"), F.col("sig").alias("_sa"))
    sb = pu.select(F.col("rep").alias("b"), F.col("sig").alias("_sb"))
    scored = (cands.join(sa, "a").join(sb, "b")
              .where(spec.comparable(F.col("_sa"), F.col("_sb")))
              .select("a", "b", F.explode(F.array(spec.score(F.col("_sa"), F.col("_sb")))).alias("score"))
              .where(spec.is_match(F.col("score"))))
    best = scored.groupBy("b").agg(F.min(F.struct(spec.badness(F.col("score")).alias("bad"),
                                                  F.col("a"), F.col("score"))).alias("m"))
    answer = pu.select(F.col("rep").alias("b"), "sig").join(best, "b", "left")
    return (p.select(F.col("id").alias("probe_id"), "sig").join(answer, "sig", "left")
            .select("probe_id", F.col("m.a").alias("match_id"), F.col("m.score").cast("double").alias("score")))


def _star_links(keys: DataFrame, items: DataFrame, spec: Spec) -> DataFrame:
    """Verified links (a, b) of each key's first holder with its other holders: at most one per item and key."""
    firsts = keys.where("is_index").groupBy("key").agg(F.min("id").alias("a"))
    near = keys.where("is_probe").join(firsts, "key").where(F.col("id") != F.col("a")).select("a", F.col("id").alias("b")).distinct()
    return written(verify_pairs(near, items, spec).select("a", "b"), "stars")


def _open_links(keys: DataFrame, labels: DataFrame, items: DataFrame, spec: Spec) -> DataFrame:
    """Verified links between holders of one key that ``labels`` (id, group_id) keeps apart.

    Of each key the label with the most holders is its main one. Every pair of holders with different labels
    has one outside the main label, so only those holders probe; the pairs inside the main label, which a
    group of near copies would make quadratic, are never formed. Large keys are dealt out in blocks.
    """
    held = keys.join(labels, "id")
    per = held.groupBy("key", "group_id").agg(F.count(F.lit(1)).alias("c"))
    several = written(per.groupBy("key").agg(F.max(F.struct("c", "group_id")).alias("m"), F.count(F.lit(1)).alias("labels"))
                      .where("labels > 1").select("key", F.col("m.group_id").alias("main")), "open-keys")
    held = written(held.join(several, "key"), "open-holders")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    every, own = F.explode(F.sequence(F.lit(0), blocks - 1)), F.pmod(F.xxhash64("id"), blocks).cast("int")
    left = held.where("is_index").select(F.col("id").alias("x"), "key", F.col("group_id").alias("gx"), own.alias("i"), every.alias("j"))
    right = held.where("is_probe AND group_id <> main").select(
        F.col("id").alias("y"), "key", F.col("group_id").alias("gy"), every.alias("i"), own.alias("j"))
    pairs = left.hint("merge").join(right, ["key", "i", "j"]).where("gx <> gy").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return written(verify_pairs(pairs.distinct(), items, spec).select("a", "b"), "open-links")


def similarity_groups(sigs: DataFrame, spec: Spec, id_col: str = "video_id") -> DataFrame:
    """(id, group_id, n): the component of each item over all matches, named by its smallest id, and its size.

    The links are a forest in spirit: copies hang on their representative, each key gives the links of its
    first holder, and only holders that are still apart are compared further. So a group of near copies gives
    about one link per item and key, never its pairs. Items without a signature are groups of their own.
    """
    every = written(prepare_items(sigs, spec, id_col, missing=True), "items")
    items = every.where("sig IS NOT NULL")
    reps, copies = collapse_copies(items)
    sig_of = written(reps.select("id", "sig", "nf"), "reps")
    keys = shared_keys(sig_of, spec)
    sig_of = sig_of.select("id", "sig")
    labels = written(connected_groups(sig_of, _star_links(keys, sig_of, spec)), "labels")
    more = _open_links(keys, labels, sig_of, spec)
    if not more.isEmpty():  # the labels are the nodes of what is left
        up = more.join(labels.select(F.col("id").alias("a"), F.col("group_id").alias("u")), "a").join(
            labels.select(F.col("id").alias("b"), F.col("group_id").alias("v")), "b").select(F.col("u").alias("a"), F.col("v").alias("b"))
        joined = connected_groups(labels.select(F.col("group_id").alias("id")).distinct(), up)
        labels = written(labels.join(joined.select(F.col("id").alias("group_id"), F.col("group_id").alias("top")), "group_id")
                         .select("id", F.col("top").alias("group_id")), "labels")
    hung = copies.select("id", "rep_id").join(labels.select(F.col("id").alias("rep_id"), "group_id"), "rep_id").select("id", "group_id")
    alone = every.where("sig IS NULL OR NOT coalesce(self_match, false)").select("id").distinct()
    alone = alone.select("id", F.col("id").alias("group_id"))
    # representatives are no smallest id of a group if the order is another column's
    groups = labels.unionByName(hung).unionByName(alone)
    sizes = groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    return groups.join(sizes.hint("merge"), "group_id").select("id", F.col("least").alias("group_id"), "n")


def connected_groups(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected components by alternating large-star / small-star rounds.

    ``nodes``: (id); ``edges``: (a, b). Returns (id, group_id) with group_id the
    smallest id of the component. Rounds are O(log^2 n); each is a join and a
    group-by over the edge list only, written to the checkpoint folder so the
    plan stays flat.
    """
    e = written(edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
                .where(F.col("u") != F.col("v")).distinct(), "cc_edges")
    while True:
        # large star: link every larger neighbour of u to min(u, neighbours of u)
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        mins = both.groupBy("u").agg(F.min("v").alias("m"))
        ls = (both.join(mins.hint("merge"), "u").where(F.col("v") > F.col("u"))
              .select(F.col("v").alias("x"), F.least("m", "u").alias("y")))
        e1 = ls.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v")) \
               .where(F.col("u") != F.col("v")).distinct()
        # small star: link v and its smaller neighbours to the smallest of them
        mins2 = e1.groupBy("v").agg(F.min("u").alias("m"))
        ss = (e1.join(mins2.hint("merge"), "v").select(F.col("u").alias("x"), F.col("m").alias("y"))
              .unionByName(mins2.select(F.col("v").alias("x"), F.col("m").alias("y"))))
        e2 = written(ss.select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"))
                     .where(F.col("u") != F.col("v")).distinct(), "cc_edges")
        # Both edge sets are distinct: equal sizes and e2 within e means no change.
        unchanged = e2.count() == e.count() and e2.join(e, ["u", "v"], "left_anti").isEmpty()
        e = e2
        if unchanged:
            break
    label = e.groupBy("v").agg(F.min("u").alias("g"))
    return (nodes.select("id").join(label.withColumnRenamed("v", "id").hint("merge"), "id", "left")
            .select("id", F.coalesce(F.col("g"), F.col("id")).alias("group_id")))
