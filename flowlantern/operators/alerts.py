"""Alert enrichment, suppression and rate limits.

No broadcast is forced here: catalogue tables read from files or literals are broadcast because the
planner sees that they are small, and a large one falls back to a shuffled join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowlantern.functions.measures import MICROS, aligned
from flowlantern.functions.net import address_bytes, prefix_key
from flowlantern.operators import ids
from flowlantern.operators.catalogues import last_by_line
from flowlantern.session import stored

TRACKERS = {"by_src": "src_ip", "by_dst": "dest_ip"}  # fixed values: what a limit may be counted by


def alert_table(events: DataFrame) -> DataFrame:
    """Alert events with signature and category as flat columns, the event key ``alert_id`` and time ``ts``."""
    flat = ids.with_hash_id(ids.flatten_eve(ids.alerts(events)))
    return flat.select(
        F.col("hash_id").alias("alert_id"),
        "ts",
        F.coalesce("gid", F.lit(1)).alias("gid"),  # the sensor's default
        F.col("signature_id").alias("sig_id"),
        "category",
        "severity",
        "src_ip",
        "dest_ip",
    )


def enrich_class(alerts: DataFrame, dim: DataFrame) -> DataFrame:
    """Adds short name and priority; events carry the description text, so that is the key. Of classes with one
    description the last line counts, so an alert stays one row."""
    lines = dim if "line_no" in dim.columns else dim.withColumn("line_no", F.lit(0))
    by_text = last_by_line(lines, "description").select(F.col("description").alias("category"), "shortname", "priority")
    return alerts.join(by_text, "category", "left")


def enrich_reference(rows: DataFrame, dim: DataFrame, column: str = "reference") -> DataFrame:
    """``system,id`` to a link; unknown systems give NULL."""
    system = F.lower(F.trim(F.substring_index(column, ",", 1)))
    ident = F.trim(F.regexp_extract(column, r"^[^,]*,(.*)$", 1))
    base = dim.select(F.col("system").alias("_system"), F.col("url").alias("_url"))
    joined = rows.join(base, system == F.col("_system"), "left")
    return joined.withColumn("reference_url", F.concat("_url", ident)).drop("_system", "_url")


def _network(text: Column) -> Column:
    """Bits and 16 bytes of ``address`` or ``address/length`` of either family; NULL for what is neither."""
    address, length = F.substring_index(text, "/", 1), F.get(F.split(text, "/"), F.lit(1))
    dotted = ~F.contains(address, F.lit(":"))
    given = F.coalesce(length.try_cast("int"), F.when(length.isNull(), F.when(dotted, 32).otherwise(128)))
    bits = F.when(given.between(0, F.when(dotted, 32).otherwise(128)), given + F.when(dotted, 96).otherwise(0))
    whole = address_bytes(address)
    return F.when(bits.isNotNull() & whole.isNotNull(), F.struct(bits.alias("bits"), whole.alias("address")))


def suppress(alerts: DataFrame, rules: DataFrame) -> DataFrame:
    """Alerts without those a suppress rule names: by generator and signature, optionally by source or target.

    A generator or signature of 0 (or none) stands for any. A list of networks, of either address family, is a rule for
    each of them; a network that cannot be read names nothing. ``alert_id`` is the key: copies of an alert go together.

    A rule is found by equality: its form says whether it names generator, signature, track and how many leading bits,
    and its key holds these values. An alert looks up one key for each form that occurs. The forms that exist are
    2 x 2 x (2 x 129 + 1), whatever the number of rules, so they are passed by value.
    """
    networks = F.split(F.regexp_replace("ip", r"[\[\]\s]", ""), ",")
    wanted = rules.filter(F.col("kind") == "suppress").select(
        F.coalesce("gen_id", F.lit(0)).alias("gen"),
        F.coalesce("sig_id", F.lit(0)).alias("sig"),
        F.col("track"),
        F.explode_outer(networks).alias("network"),
    )
    free = F.col("network").isNull()  # a rule without a network covers the whole signature
    wanted = wanted.withColumn("net", _network(F.col("network")))
    wanted = wanted.filter(free | (F.col("net").isNotNull() & F.col("track").isin(*TRACKERS)))
    form = {"by_gen": F.col("gen") != 0, "by_sig": F.col("sig") != 0, "track": F.when(~free, F.col("track")), "bits": F.col("net.bits")}
    leading = F.coalesce(prefix_key(F.col("net.address"), F.col("net.bits")), F.lit(""))
    wanted = wanted.select(*[c.alias(name) for name, c in form.items()], "gen", "sig", leading.alias("leading"))
    wanted = stored(wanted.distinct(), "suppressions")  # the lines are parsed once, and the planner knows their size
    forms = wanted.select(*form).distinct().collect()
    if not forms:
        return alerts

    def key(form: dict, gen: Column, sig: Column, leading: Column) -> Column:
        named = [F.coalesce(c.cast("string"), F.lit("")) for c in form.values()]
        return F.concat_ws("/", *named, F.concat(gen.cast("string"), F.lit("/"), sig.cast("string"), F.lit("/"), leading))

    def lookup(found: dict) -> Column:
        gen, sig = (F.col(c) if by else F.lit(0) for c, by in (("gid", found["by_gen"]), ("sig_id", found["by_sig"])))
        leading = F.lit("") if found["track"] is None else prefix_key(F.col(found["track"]), F.lit(found["bits"]))
        # without a field that the form asks for there is nothing to look up
        own = key({name: F.lit(value) for name, value in found.items()}, gen, sig, leading)
        return F.when(gen.isNotNull() & sig.isNotNull() & leading.isNotNull(), own)

    tracked = [address_bytes(name).alias(track) for track, name in TRACKERS.items()]
    probes = alerts.select("alert_id", "gid", "sig_id", *tracked)
    probes = probes.select("alert_id", F.explode(F.array(*[lookup(f.asDict()) for f in forms])).alias("key"))
    named = wanted.select(key({name: F.col(name) for name in form}, F.col("gen"), F.col("sig"), F.col("leading")).alias("key"))
    hit = probes.filter(F.col("key").isNotNull()).join(named, "key", "left_semi").select("alert_id").distinct()
    return alerts.join(hit, "alert_id", "left_anti")


def apply_limits(alerts: DataFrame, rules: DataFrame) -> DataFrame:
    """Alerts left by the threshold and event_filter lines of a catalogue.

    An alert follows the last line for its generator and signature, else the last for its generator and any
    signature, else the last for any generator and signature; without any it stays. Kinds and periods are
    those of ``rate_limit``.
    """
    settings = ["type", "track", "count", "seconds"]
    limits = rules.filter(F.col("kind").isin("threshold", "event_filter") & F.col("type").isNotNull())
    limits = limits.withColumns({k: F.coalesce(k, F.lit(0)) for k in ("gen_id", "sig_id")})
    limits = last_by_line(limits, "gen_id", "sig_id").select("gen_id", "sig_id", F.struct(*settings).alias("limit"))
    any_sig = F.col("sig_id") == 0

    def named(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(F.col("gen_id").alias("_gen"), F.col("sig_id").alias("_sig"), F.col("limit").alias(name))

    exact, by_gen = named(limits.filter(~any_sig), "_exact"), named(limits.filter(any_sig), "_any")
    found = alerts.join(exact, (F.col("gid") == F.col("_gen")) & (F.col("sig_id") == F.col("_sig")), "left")
    found = found.drop("_gen", "_sig").join(by_gen, F.col("gid") == F.col("_gen"), "left").drop("_gen", "_sig")
    rest = by_gen.select(F.col("_gen").alias("_zero"), F.col("_any").alias("_rest")).filter(F.col("_zero") == 0)
    found = found.withColumn("_gen", F.lit(0).cast("bigint")).join(rest, F.col("_gen") == F.col("_zero"), "left")
    found = found.withColumn("_limit", F.coalesce("_exact", "_any", "_rest")).drop("_exact", "_any", "_rest", "_gen", "_zero")
    limit = F.col("_limit")
    tracked = F.when(limit["track"] == "by_src", F.col("src_ip")).when(limit["track"] == "by_dst", F.col("dest_ip"))
    micros = F.unix_micros("ts")
    period = micros - F.pmod(micros, limit["seconds"].cast("bigint") * MICROS)
    free = found.filter(limit.isNull()).drop("_limit")
    bound = found.filter(limit.isNotNull()).withColumns({"_tracked": tracked, "_period": period})
    rank = F.row_number().over(Window.partitionBy("gid", "sig_id", "_tracked", "_period").orderBy("ts", "alert_id"))
    bound = bound.withColumn("_rank", rank)
    n, r = limit["count"], F.col("_rank")
    keep = F.when(limit["type"] == "limit", r <= n).when(limit["type"] == "both", r == n).otherwise(r % n == 0)
    return free.unionByName(bound.filter(keep).drop("_limit", "_tracked", "_period", "_rank"))


def rate_limit(
    alerts: DataFrame,
    kind: str = "limit",
    n: int = 1,
    seconds: int = 60,
    track: str = "by_src",
    slices: int = 256,
) -> DataFrame:
    """Alerts left after a limit per signature, tracked address and calendar-aligned period.

    ``limit`` keeps the first ``n``, ``both`` the n-th only, ``threshold`` every n-th. The first two
    need the first ``n`` ranks: the planner may apply that limit before the shuffle too, so a hot address
    sends at most ``n`` alerts per task and period. The third needs the rank of every alert, see ``_ranked``.
    """
    if kind not in ("limit", "threshold", "both"):
        raise ValueError(f"kind must be limit, threshold or both, not {kind!r}")
    group = ["sig_id", TRACKERS[track], "period"]
    timed = alerts.withColumn("period", aligned(F.unix_micros("ts"), seconds * MICROS))
    if kind == "threshold":
        ranked = _ranked(timed, group, seconds, slices)
    else:
        order = Window.partitionBy(*group).orderBy("ts", "alert_id")
        ranked = timed.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)
    rank = F.col("rank")
    kept = ranked.filter({"limit": rank <= n, "both": rank == n, "threshold": rank % n == 0}[kind])
    return kept.drop("period", "rank")


def _ranked(timed: DataFrame, group: list[str], seconds: int, slices: int) -> DataFrame:
    """Exact rank of each row in its group without sorting a whole group in one task.

    A period is cut into equal time slices. Ranks are taken inside a slice; the rows of the earlier
    slices are added from counts that are combined before their shuffle (at most ``slices`` per group).
    """
    width = max(1, seconds * MICROS // slices)
    # One text key with a mark for missing parts joins by plain equality, so rows stay where the
    # window put them.
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("~")) for name in group]
    sliced = timed.withColumns(
        {
            "_group": F.concat_ws("|", *parts),
            "_slice": F.coalesce(aligned(F.unix_micros("ts"), width), F.lit(-1)),
        }
    )
    counts = sliced.groupBy("_group", "_slice").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("_group").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_group", "_slice", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_group", "_slice").orderBy("ts", "alert_id")
    ranked = sliced.withColumn("_inside", F.row_number().over(inside)).join(offsets, ["_group", "_slice"])
    return ranked.withColumn("rank", F.col("_before") + F.col("_inside")).drop("_group", "_slice", "_before", "_inside")
