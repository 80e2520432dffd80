"""Instrument definitions: built from listings, looked up, compared, validated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions import keys as k
from tickloom.functions import symbols as sy
from tickloom.schemas import DATA_TYPES, INSTRUMENT_REQUIRED, INSTRUMENT_TYPES, VENUES

FAR_FUTURE = "2099-12-31 00:00:00"
# Days of one definition that go through a shuffle as one row.
PIECE_DAYS = 8


def eligibility(listing: DataFrame, start: str, end: str) -> DataFrame:
    """Parse a listing and mark why a symbol is left out.

    ``skip_reason`` is NULL for an eligible symbol, else ``aggregate``,
    ``unparsed_expiry``, ``date_range``, ``combo``, ``leveraged``,
    ``quote_asset`` or ``silent_combo``. ``start`` and ``end`` are days.
    """
    exchange, symbol, kind = F.col("exchange"), F.col("symbol_id"), F.col("symbol_type")
    contract = kind.isin("future", "option")
    parsed = sy.with_expiry(sy.with_assets(listing)).withColumns({
        "strike": sy.strike(exchange, symbol, kind),
        "option_type": sy.option_type(exchange, symbol, kind),
    })
    first, last = F.try_to_timestamp("available_since"), F.try_to_timestamp("available_to")
    open_end = F.when(kind.isin("spot", "perpetual"), F.lit(FAR_FUTURE).cast("timestamp")).otherwise(
        F.col("symbol_expiry").cast("timestamp"))
    parsed = sy.staged(parsed, {"_from": first, "_to": F.when(F.col("available_to").isNull(), open_end).otherwise(last)})

    # Contracts on these venues trade from 08:00 to 08:00.
    at_eight = exchange.isin(*sy.SETTLE_AT_EIGHT) & contract
    parsed = sy.staged(parsed, {
        "_from": F.when(at_eight & (F.hour("_from") == 0), F.col("_from") + F.expr("INTERVAL 8 HOURS")).otherwise(F.col("_from")),
        "_to": F.when(at_eight & (F.hour("_to") == 0), F.col("_to") - F.expr("INTERVAL 16 HOURS")).otherwise(F.col("_to")),
    })
    wanted_quote = (
        F.when(exchange == "upbit", F.col("quote_asset") == "KRW")
        .when(exchange == "deribit", F.col("quote_asset").isin("USD", "USDT", "USDC"))
        .otherwise(F.col("quote_asset") == "USDT")
    )
    leveraged = symbol.rlike("|".join(sy.LEVERAGED))
    undated = F.col("_from").isNull() | F.col("_to").isNull()
    reason = (
        F.when(symbol.isin(*sy.AGGREGATES) | ((symbol == "OPTIONS") & (exchange != "deribit")), "aggregate")
        .when(undated & (kind == "combo"), "silent_combo")
        .when(undated, "unparsed_expiry")
        .when((F.to_date("_from") > F.lit(end).cast("date")) | (F.to_date("_to") < F.lit(start).cast("date")), "date_range")
        .when((exchange == "deribit") & (kind == "combo"), "combo")
        .when(leveraged, "leveraged")
        .when(~wanted_quote, "quote_asset")
    )
    return sy.staged(parsed, {
        "skip_reason": reason,
        "expiry_date": F.when(at_eight, F.to_date("_to")).otherwise(F.col("symbol_expiry")),
    })


def definitions(listing: DataFrame, start: str, end: str) -> DataFrame:
    """Instrument definitions of the eligible symbols; the last of equal keys wins."""
    e = eligibility(listing, start, end).where(F.col("skip_reason").isNull())
    exchange, kind = F.col("exchange"), F.col("symbol_type")
    base, quote = F.upper("base_asset"), F.upper("quote_asset")
    contract = kind.isin("future", "option")
    key = k.canonical_key(exchange, kind, base, quote, F.col("expiry_date"), F.col("strike"), F.col("option_type"))
    iso = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
    expiry = F.when(contract & F.col("expiry_date").isNotNull(),
                    F.concat(F.date_format("expiry_date", "yyyy-MM-dd"), F.lit("T08:00:00+00:00")))
    rows = sy.staged(e, {"instrument_key": key}).where(F.col("instrument_key").isNotNull()).select(
        "instrument_key",
        k.part("instrument_key", 1).alias("venue"), k.part("instrument_key", 2).alias("instrument_type"),
        F.date_format("_from", iso).alias("available_from_datetime"), F.date_format("_to", iso).alias("available_to_datetime"),
        F.concat_ws(",", k.data_types(F.col("instrument_key"))).alias("data_types"),
        base.alias("base_asset"), quote.alias("quote_asset"), F.upper("settle_asset").alias("settle_asset"),
        F.col("symbol_id").alias("exchange_raw_symbol"), F.col("symbol_id").alias("tardis_symbol"),
        exchange.alias("tardis_exchange"),
        F.lit("tardis").alias("data_provider"), F.lit("exchange").alias("venue_type"), F.lit("crypto").alias("asset_class"),
        ((kind == "perpetual") & (F.col("settle_asset") != F.col("quote_asset"))).alias("inverse"),
        F.upper(kind).alias("symbol_type"),
        F.coalesce("strike", F.lit("")).alias("strike"), F.coalesce("option_type", F.lit("")).alias("option_type"),
        F.coalesce(expiry, F.lit("")).alias("expiry"),
        F.when(contract, F.lit(1.0)).alias("contract_size"),
        F.when(contract, "cash").otherwise("").alias("settlement_type"),
        F.when(contract, F.concat_ws("-", base, quote)).otherwise("").alias("underlying"),
    )
    return last_per_key(rows, ["instrument_key"], ["available_from_datetime", "available_to_datetime", "exchange_raw_symbol"])


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by ``order``; copies are combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return (
        df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*")
        .select(*df.columns)
    )


def windowed(instruments: DataFrame, start: str, end: str) -> DataFrame:
    """Definitions that live inside the range, with ``first_day`` and ``last_day`` of that."""
    first = F.greatest(F.to_date(F.try_to_timestamp("available_from_datetime")), F.lit(start).cast("date"))
    last = F.least(F.to_date(F.try_to_timestamp("available_to_datetime")), F.lit(end).cast("date"))
    return instruments.withColumns({"first_day": first, "last_day": last}).where(F.col("first_day") <= F.col("last_day"))


def dealt(ranges: DataFrame) -> DataFrame:
    """Rows that are to become many, such as ranges of days, over all shuffle partitions.

    A small file of definitions is one task, and Spark joins small partitions: without
    this one task would write out all days.
    """
    return ranges.repartition(int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def daily(instruments: DataFrame, start: str, end: str) -> DataFrame:
    """One row per instrument and day of its life inside the range.

    The days are generated from each row's own window; there is no cross join.
    """
    ranges = dealt(windowed(instruments, start, end))
    return ranges.withColumn("day", F.explode(F.sequence("first_day", "last_day"))).drop("first_day", "last_day")


def pieces(ranges: DataFrame) -> DataFrame:
    """Rows with ``first_day`` and ``last_day`` cut at multiples of ``PIECE_DAYS``; ``piece`` is the number of the piece."""
    number = lambda day: F.floor(F.unix_date(day) / PIECE_DAYS).cast("int")
    cut = ranges.withColumn("piece", F.explode(F.sequence(number("first_day"), number("last_day"))))
    return cut.withColumns({
        "first_day": F.greatest("first_day", F.date_from_unix_date(F.col("piece") * PIECE_DAYS)),
        "last_day": F.least("last_day", F.date_from_unix_date(F.col("piece") * PIECE_DAYS + PIECE_DAYS - 1))})


def merge_days(daily: DataFrame) -> DataFrame:
    """Daily definitions as ranges: one row per run of days on which a definition was the same in all columns.

    ``first_day`` and ``last_day`` take the place of ``day``. A gap, or a change in any
    column, starts a new range; repeated rows count once. Days are combined before the
    shuffle, 64 of them in the bits of one LONG; windows hold the runs of one definition.
    """
    columns = [c for c in daily.columns if c != "day"]
    number = F.unix_date("day")
    block = F.floor(number / 64).cast("int")
    bits = daily.groupBy(*columns, block.alias("_block")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number, F.lit(64)))).alias("_bits"))

    def places(mask: Column) -> Column:
        """Numbers of the bits that are set, in order."""
        return F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftright", mask, i).bitwiseAND(1) == 1)

    mask = F.col("_bits")
    ends = F.arrays_zip(  # a run starts where the bit below is not set and ends where the bit above is not
        places(mask.bitwiseAND(F.bitwise_not(F.shiftleft(mask, 1)))).alias("first"),
        places(mask.bitwiseAND(F.bitwise_not(F.shiftrightunsigned(mask, 1)))).alias("last"))
    runs = bits.withColumn("_run", F.explode_outer(ends)).select(
        *columns, (F.col("_block") * 64 + F.col("_run.first")).alias("_first"), (F.col("_block") * 64 + F.col("_run.last")).alias("_last"))
    order = Window.partitionBy(*columns).orderBy("_first")
    new = F.coalesce(F.col("_first") != F.lag("_last").over(order) + 1, F.lit(True)).cast("int")
    numbered = runs.withColumn("_new", new).withColumn("_island", F.sum("_new").over(order))
    return numbered.groupBy(*columns, "_island").agg(
        F.date_from_unix_date(F.min("_first")).alias("first_day"), F.date_from_unix_date(F.max("_last")).alias("last_day")).drop("_island")


def range_days(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """The rows of :func:`merge_days` by day again, for the days from ``start`` to ``end``."""
    first = F.greatest("first_day", F.lit(start).cast("date"))
    last = F.least("last_day", F.lit(end).cast("date"))
    return ranges.where(first <= last).withColumn("day", F.explode(F.sequence(first, last))).drop("first_day", "last_day")


def definitions_by_day(daily: DataFrame, ranges: DataFrame, start: str, end: str) -> DataFrame:
    """Definitions of each day from ``start`` to ``end``: of the daily table, and of the ranges on days it does not have.

    ``source`` says which (``daily`` or ``range``). A day that neither has gives no row.
    """
    inside = F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    own = daily.where(inside)
    rest = range_days(ranges, start, end).join(own.select("day").distinct(), "day", "left_anti")
    return own.withColumn("source", F.lit("daily")).unionByName(rest.withColumn("source", F.lit("range")), allowMissingColumns=True)


def available_on(instruments: DataFrame, day: str) -> DataFrame:
    """Definitions whose window holds the day; both spellings of the window columns."""
    def time(*names: str) -> Column:
        present = [F.try_to_timestamp(F.col(n).cast("string")) for n in names if n in instruments.columns]
        return F.coalesce(*present)

    start = time("available_from_datetime", "available_from")
    end = time("available_to_datetime", "available_to")
    at = F.lit(day).cast("timestamp")
    return instruments.where((start <= at) & (end >= at))


def select_instruments(
    instruments: DataFrame,
    venue: str | Sequence[str] | None = None,
    instrument_type: str | Sequence[str] | None = None,
    base_asset: str | Sequence[str] | None = None,
    quote_asset: str | Sequence[str] | None = None,
    underlying: str | Sequence[str] | None = None,
    expiry: str | Sequence[str] | None = None,
    max_results: int | None = None,
) -> DataFrame:
    """Case-insensitive membership filters, expiry by any of the given substrings."""
    def listed(value) -> list[str]:
        return [value] if isinstance(value, str) else list(value)

    out = instruments
    for column, value in {
        "venue": venue, "instrument_type": instrument_type, "base_asset": base_asset,
        "quote_asset": quote_asset, "underlying": underlying,
    }.items():
        if value:
            out = out.where(F.upper(column).isin(*[v.upper() for v in listed(value)]))
    if expiry:
        hit = F.lit(False)
        for text in listed(expiry):
            hit = hit | F.col("expiry").contains(text)
        out = out.where(hit)
    return out.orderBy("instrument_key").limit(max_results) if max_results else out


def find(instruments: DataFrame, targets: DataFrame, target: str = "target") -> DataFrame:
    """Best definition for each requested key: exact, else by venue, type and terms.

    Each strategy is an equi join, so a long list of targets costs one shuffle
    per strategy; the first strategy that matches wins.
    """
    t = targets.select(target).distinct()
    symbol = F.split(k.part(target, 3), "-")
    t = t.withColumns({
        "_venue": k.part(target, 1), "_type": k.part(target, 2),
        "_base": F.get(symbol, F.lit(0)), "_quote": F.get(symbol, F.lit(1)),
        "_strike": F.get(symbol, F.lit(3)), "_side": F.get(symbol, F.lit(4)), "_parts": F.size(symbol),
    })
    # The first definition by key answers when several share the same terms.
    i = instruments.select("instrument_key", "venue", "instrument_type", "base_asset", "quote_asset", "strike", "option_type")
    pairs = i.where(F.col("instrument_type").isin("PERPETUAL", "SPOT_PAIR")).groupBy(
        "venue", "instrument_type", "base_asset", "quote_asset").agg(F.min("instrument_key").alias("_pair_key"))
    options = i.where(F.col("instrument_type") == "OPTION").groupBy(
        "venue", "instrument_type", "base_asset", "quote_asset", "strike", "option_type").agg(
        F.min("instrument_key").alias("_option_key"))
    exact = i.select(F.col("instrument_key").alias("_exact_key")).distinct()

    same = lambda d: (
        (F.col("_venue") == d["venue"]) & (F.col("_type") == d["instrument_type"])
        & (F.col("_base") == d["base_asset"]) & (F.col("_quote") == d["quote_asset"]))
    joined = (
        t.join(exact, F.col(target) == F.col("_exact_key"), "left")
        .join(pairs, same(pairs) & (F.col("_parts") == 2), "left")
        .join(options, same(options) & (F.col("_parts") >= 5) & (F.col("_strike") == options["strike"])
              & (F.col("_side") == options["option_type"]), "left")
    )
    return joined.select(
        target,
        F.coalesce("_exact_key", "_pair_key", "_option_key").alias("instrument_key"),
        F.when(F.col("_exact_key").isNotNull(), "exact").when(F.col("_pair_key").isNotNull(), "components")
        .when(F.col("_option_key").isNotNull(), "option_terms").otherwise("none").alias("matched_by"),
    )


def similar(instruments: DataFrame, target: str, limit: int | None = None) -> DataFrame:
    """Keys that contain the venue of ``target``, in key order; all of them unless ``limit`` says how many."""
    venue = target.split(":")[0]
    found = instruments.select("instrument_key").where(F.col("instrument_key").contains(venue)).distinct().orderBy("instrument_key")
    return found if limit is None else found.limit(limit)


def market_matches(
    symbol: str | None = None, base: str | None = None, quote: str | None = None, product_type: str | None = None
) -> Column:
    """Predicate over market rows (``symbol, id, base, quote, type``).

    A base also matches its ``1000``-lot listing.
    """
    hit = F.lit(True)
    if symbol:
        hit = hit & ((F.col("symbol") == symbol) | (F.col("id") == symbol))
    if base:
        hit = hit & F.col("base").isin(base, "1000" + base)
    if quote:
        hit = hit & (F.col("quote") == quote)
    if product_type:
        wanted = product_type.lower()
        hit = hit & (
            F.when(F.col("type") == "swap", F.lit(wanted in ("perpetual", "perp", "swap"))).otherwise(F.col("type") == wanted))
    return hit


def active_markets(
    markets: DataFrame, bases: Sequence[str] = (), quotes: Sequence[str] = (), types: Sequence[str] = (),
    predicate: Column | None = None,
) -> DataFrame:
    """Active markets by base, quote and type, and any further predicate."""
    out = markets.where(F.coalesce("active", F.lit(True)))
    for column, allowed in (("base", bases), ("quote", quotes), ("type", types)):
        if allowed:
            out = out.where(F.col(column).isin(*allowed))
    return out if predicate is None else out.where(predicate)


def combine_filters(own: Sequence[str], asked: Sequence[str]) -> list[str]:
    """Values allowed by both lists; an empty request leaves the own list."""
    return [x for x in own if x in set(asked)] if asked else list(own)


def live_definitions(markets: DataFrame) -> DataFrame:
    """Instrument rows from market records of a live listing."""
    kind, exchange = F.col("type"), F.col("exchange_id")
    venue = (
        F.when(exchange == "binance", F.when(kind == "spot", "BINANCE-SPOT").otherwise("BINANCE-FUTURES"))
        .when(exchange == "deribit", "DERIBIT")
        .when(exchange.isin("coinbase", "kraken", "bitfinex"), F.concat(F.upper(exchange), F.lit("-SPOT")))
        .otherwise(F.upper(exchange))
    )
    pair = F.concat_ws("-", "base", "quote")
    ymd = F.date_format("expiry", "yyMMdd")
    symbol = (
        F.when(kind == "option", F.concat_ws(
            "-", pair, F.coalesce(ymd, F.lit("000000")), F.coalesce(F.col("strike").cast("int"), F.lit(0)).cast("string"),
            F.upper(F.coalesce("option_type", F.lit("call")))))
        .when(kind.isin("future", "swap") & F.col("expiry").isNotNull(), F.concat_ws("-", pair, ymd))
        .otherwise(pair)
    )
    instrument_type = (
        F.when(kind == "option", "OPTION")
        .when(kind.isin("future", "swap"), F.when(F.col("expiry").isNotNull(), "FUTURE").otherwise("PERPETUAL"))
        .otherwise("SPOT_PAIR")
    )
    types = (
        F.when(kind.isin("future", "swap"), "trades,book_snapshot_5,derivative_ticker,liquidations")
        .when(kind == "option", "trades,book_snapshot_5,options_chain").otherwise("trades,book_snapshot_5")
    )
    vendor_symbol = F.when(exchange == "binance", F.lower(F.replace(F.col("id"), F.lit("/"), F.lit("")))).when(
        exchange == "coinbase", F.replace(F.col("id"), F.lit("/"), F.lit("-"))).otherwise(F.col("id"))
    return markets.select(
        F.concat_ws(":", venue, instrument_type, symbol).alias("instrument_key"), venue.alias("venue"),
        F.upper(kind).alias("instrument_type"), types.alias("data_types"),
        F.col("base").alias("base_asset"), F.col("quote").alias("quote_asset"),
        F.coalesce("settle", "quote").alias("settle_asset"), F.col("id").alias("exchange_raw_symbol"),
        vendor_symbol.alias("tardis_symbol"),
        F.when(exchange == "coinbase", "coinbase-pro").otherwise(exchange).alias("tardis_exchange"),
        F.lit("CCXT").alias("data_provider"), F.lit("centralized").alias("venue_type"), F.lit("crypto").alias("asset_class"),
        F.col("symbol").alias("ccxt_symbol"), exchange.alias("ccxt_exchange"),
        F.when(kind == "option", F.col("strike")).alias("strike_price"),
        F.when(kind == "option", F.col("option_type")).alias("option_type"),
    )


def changes(before: DataFrame, after: DataFrame, on: Sequence[str] = ("exchange", "symbol")) -> DataFrame:
    """Symbols added to or removed from a listing since the previous snapshot."""
    a = before.select(*on).distinct().withColumn("_before", F.lit(True))
    b = after.select(*on).distinct().withColumn("_after", F.lit(True))
    return (
        a.join(b, list(on), "full_outer")
        .withColumn("change", F.when(F.col("_before").isNull(), "added").when(F.col("_after").isNull(), "removed"))
        .where(F.col("change").isNotNull())
        .select(*on, "change")
    )


def requested_but_unknown(requested: DataFrame, instruments: DataFrame, limit: int | None = None) -> DataFrame:
    """Requested keys without a definition, by key; all of them unless ``limit`` says how many."""
    found = requested.select("instrument_key").distinct().join(instruments, "instrument_key", "left_anti").orderBy("instrument_key")
    return found if limit is None else found.limit(limit)


# -- validation ------------------------------------------------------------------

def _issues(*pairs: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(text)) for c, text in pairs]))


def validate(instruments: DataFrame) -> DataFrame:
    """Add ``errors``, ``warnings`` and ``missing_fields`` to each definition."""
    def blank(c: str) -> Column:
        return F.col(c).isNull() | (F.trim(c) == "") if c in instruments.columns else F.lit(True)

    def bad_time(c: str) -> Column:
        return F.try_to_timestamp(c).isNull()

    unknown_types = F.exists(
        F.split("data_types", ","), lambda t: ~F.trim(t).isin(*DATA_TYPES))
    expiry_there = ~blank("expiry")
    derivative = F.col("instrument_type").isin("FUTURE", "OPTION")
    option = F.col("instrument_type") == "OPTION"
    errors = _issues(
        (F.size(F.split("instrument_key", ":")) < 3, "instrument_key"),
        (bad_time("available_from_datetime"), "available_from_datetime"),
        (bad_time("available_to_datetime"), "available_to_datetime"),
        (blank("data_types"), "data_types"),
        (expiry_there & bad_time("expiry"), "expiry"),
        (~blank("option_type") & ~F.col("option_type").isin("CALL", "PUT"), "option_type"),
    )
    warnings = _issues(
        (~k.part("instrument_key", 1).isin(*VENUES), "unknown_venue"),
        (~k.part("instrument_key", 2).isin(*INSTRUMENT_TYPES), "unknown_instrument_type"),
        (unknown_types, "unknown_data_type"),
        (derivative & blank("expiry"), "missing_expiry"),
        (option & blank("strike"), "missing_strike"),
        (option & blank("option_type"), "missing_option_type"),
    )
    missing = _issues(*[(blank(c), c) for c in INSTRUMENT_REQUIRED])
    return instruments.select("*", errors.alias("errors"), warnings.alias("warnings"), missing.alias("missing_fields"))


# -- shapes and counts -------------------------------------------------------------

SUMMARY_COLUMNS = (
    "instrument_key", "venue", "instrument_type", "base_asset", "quote_asset", "settle_asset",
    "available_from", "available_to", "data_types", "expiry", "strike", "option_type", "inverse", "underlying",
    "exchange_raw_symbol", "tardis_symbol", "tardis_exchange",
)


def summary(instruments: DataFrame) -> DataFrame:
    renamed = instruments.withColumnsRenamed({
        "available_from_datetime": "available_from", "available_to_datetime": "available_to"})
    return renamed.select(*[c for c in SUMMARY_COLUMNS if c in renamed.columns])


def iso_times(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Timestamps as ISO text."""
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssXXX") for c in columns})


def statistics(instruments: DataFrame) -> DataFrame:
    """Counts by venue, by type, by both and by base asset, from one shuffle."""
    grouped = instruments.groupingSets(
        [[F.col("venue")], [F.col("instrument_type")], [F.col("venue"), F.col("instrument_type")], [F.col("base_asset")], []],
        F.col("venue"), F.col("instrument_type"), F.col("base_asset"),
    ).agg(F.count(F.lit(1)).alias("instruments"), F.grouping_id().alias("_id"))
    # Bits: venue 4, instrument_type 2, base_asset 1; a set bit means "not grouped".
    level = F.when(F.col("_id") == 3, "venue").when(F.col("_id") == 5, "instrument_type").when(
        F.col("_id") == 1, "venue_and_type").when(F.col("_id") == 6, "base_asset").otherwise("total")
    return grouped.select(level.alias("level"), "venue", "instrument_type", "base_asset", "instruments")


def top_bases(instruments: DataFrame, n: int = 10) -> DataFrame:
    return instruments.groupBy("base_asset").agg(F.count(F.lit(1)).alias("instruments")).orderBy(
        F.col("instruments").desc(), "base_asset").limit(n)


def by_underlying(instruments: DataFrame) -> DataFrame:
    """(underlying, instrument_key) pairs, and how many instruments share it."""
    pairs = instruments.select(
        k.underlying(F.col("instrument_type"), F.col("base_asset"), F.col("underlying")).alias("underlying"), "instrument_key"
    ).where(F.col("underlying").isNotNull() & (F.col("underlying") != "")).distinct()
    counts = pairs.groupBy("underlying").agg(F.count(F.lit(1)).alias("instruments"))
    return pairs.join(counts, "underlying")

