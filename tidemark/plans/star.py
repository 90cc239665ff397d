"""Reference-shaped inputs derived from the star-schema tables.

region, nation, customer and orders stand for province, regency, district and village;
events become square footprints; regions, nations and customers become tiles of a grid.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import codes, geo
from tidemark.operators import overlap
from tidemark.session import broadcast_if_small, cut_by_key, cut_lineage, spread

WEST, SOUTH = 100.0, -5.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents spread for text work; one file of long texts is a single split."""
    return spread(table(spark, sf_dir, "documents"))


def province_code(key: Column) -> Column:
    return codes.padded(key + 11, 2)


def regency_suffix(key: Column) -> Column:
    return codes.padded(key + 1, 2)


def regencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    code = F.concat_ws(".", province_code(F.col("n_regionkey")), regency_suffix(F.col("n_nationkey")))
    return n.select("n_nationkey", code.alias("code"), F.col("n_name").alias("name"))


def district_code(regency: Column, key: Column) -> Column:
    return F.concat_ws(".", regency, codes.padded(key, 7))


def customer_regencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the code of their regency; nations are a dimension of fixed size."""
    r = regencies(spark, sf_dir).select("n_nationkey", F.col("code").alias("_r"))
    return table(spark, sf_dir, "customer").join(r, F.col("c_nationkey") == F.col("n_nationkey"))


def district_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer key to district code."""
    code = district_code(F.col("_r"), F.col("c_custkey")).alias("code")
    return customer_regencies(spark, sf_dir).select("c_custkey", "c_name", "c_acctbal", code)


def village_orders(orders: DataFrame, districts: DataFrame, public: bool = False) -> DataFrame:
    """Orders with their district and their village's code in place of the district's.

    With ``public`` only those whose code is of a public level, found before the join: a code of
    four segments takes an order's key and a district of three, so that an order without a key and
    one of a shorter district remain, which are few.
    """
    at = F.col("o_custkey") == F.col("c_custkey")
    if public:
        keyless = orders.filter("o_orderkey IS NULL")
        short = districts.filter(codes.segments(F.col("code")) < 3)
        joined = (broadcast_if_small(keyless, 128) or keyless).join(districts, at).unionByName(
            orders.filter("o_orderkey IS NOT NULL").join(broadcast_if_small(short, 128) or short, at)
        )
    else:
        joined = orders.join(districts, at)
    return joined.withColumn("code", F.concat_ws(".", "code", codes.padded(F.col("o_orderkey"), 9)))


def admin_codes(spark: SparkSession, sf_dir: str, village: bool = True, public: bool = False) -> DataFrame:
    """``code, name`` of the whole hierarchy, or of its ``public`` levels."""
    reg = table(spark, sf_dir, "region")
    parts = [
        reg.select(province_code(F.col("r_regionkey")).alias("code"), F.col("r_name").alias("name")),
        regencies(spark, sf_dir).select("code", "name"),
    ]
    d = district_codes(spark, sf_dir)
    parts.append(d.select("code", F.col("c_name").alias("name")))
    if village:
        o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        v = village_orders(o, d.select("c_custkey", "code"), public)
        parts.append(v.select("code", F.col("o_orderpriority").alias("name")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def admin_units(spark: SparkSession, sf_dir: str, village: bool = True) -> DataFrame:
    base = admin_codes(spark, sf_dir, village)
    h = codes.hierarchy(F.col("code"))
    return base.select("code", "name", *(c.alias(n) for n, c in h.items()))


def grid_side(spark: SparkSession, sf_dir: str) -> Column:
    """Tiles along one side of the district grid: 100, or what gives every customer a tile of
    its own. A multiple of 37 would fold tiles together and is passed over."""
    c = table(spark, sf_dir, "customer")
    least = F.greatest(F.lit(100), F.ceil(F.sqrt(F.coalesce(F.max("c_custkey"), F.lit(0)) + 1)).cast("long"))
    return c.agg((least + (least % 37 == 0).cast("long")).alias("side")).scalar()


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``level, code, xmin, ymin, xmax, ymax`` of province, regency and district tiles."""
    reg = table(spark, sf_dir, "region").select(
        F.lit("province").alias("level"),
        province_code(F.col("r_regionkey")).alias("code"),
        (F.col("r_regionkey") * 2.0 + WEST).alias("xmin"),
        F.lit(SOUTH).alias("ymin"),
        (F.col("r_regionkey") * 2.0 + WEST + 2.0).alias("xmax"),
        F.lit(SOUTH + 10.0).alias("ymax"),
    )
    k = F.col("n_nationkey")
    nat = regencies(spark, sf_dir).select(
        F.lit("regency").alias("level"),
        "code",
        ((k % 5) * 2.0 + WEST).alias("xmin"),
        (F.floor(k / 5) * 2.0 + SOUTH).alias("ymin"),
        ((k % 5) * 2.0 + WEST + 2.0).alias("xmax"),
        (F.floor(k / 5) * 2.0 + SOUTH + 2.0).alias("ymax"),
    )
    side = F.col("side")
    slot = (F.col("c_custkey") * 37) % (side * side)
    col, row = slot % side, F.floor(slot / side)
    cus = district_codes(spark, sf_dir).withColumn("side", grid_side(spark, sf_dir)).select(
        F.lit("district").alias("level"),
        "code",
        (col * 10.0 / side + WEST).alias("xmin"),
        (row * 10.0 / side + SOUTH).alias("ymin"),
        ((col + 1) * 10.0 / side + WEST).alias("xmax"),
        ((row + 1) * 10.0 / side + SOUTH).alias("ymax"),
    )
    return reg.unionByName(nat).unionByName(cus)


def unit_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles as ``level, code, rings, edges, extent``."""
    rings = geo.box(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))
    return tiles(spark, sf_dir).select(
        "level",
        "code",
        rings.alias("rings"),
        geo.ring_edges(rings).alias("edges"),
        F.struct("xmin", "ymin", "xmax", "ymax").alias("extent"),
    )


_prepared: dict[tuple, DataFrame] = {}


def _state(spark: SparkSession, sf_dir: str) -> int:
    """Newest change among the tables of a folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return max((s.getModificationTime() for s in found), default=0)


def prepared(
    name: str, spark: SparkSession, sf_dir: str, build: Callable[[], DataFrame], by: str | None = None
) -> DataFrame:
    """A written hand-off table between stages, made once per application and state of the input;
    bucketed by a column when one is named."""
    key = (spark.sparkContext.applicationId, sf_dir, _state(spark, sf_dir), name)
    if key not in _prepared:
        _prepared[key] = cut_by_key(build(), by) if by else cut_lineage(build())
    return _prepared[key]


def unit_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell fragments of all tiles."""
    return prepared(
        "unit_fragments", spark, sf_dir, lambda: overlap.unit_fragments(unit_shapes(spark, sf_dir))
    )


def squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as squares: ``row_id, uuid, start_date, end_date, lon, lat, half``.

    Squares shrink with the tiles, so that one meets as many districts at any size of the tables.
    """
    k = F.col("event_id")
    return spread(table(spark, sf_dir, "events").drop("props")).select(
        k.alias("row_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("uuid"),
        F.date_format("ts", "yyyy-MM-dd").alias("start_date"),
        F.when(F.col("event_type") == "click", F.lit(None).cast("string"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("end_date"),
        (F.lit(WEST) + ((k * 7919) % 9000 + 500) / 1000.0).alias("lon"),
        (F.lit(SOUTH) + ((k * 104729) % 9000 + 500) / 1000.0).alias("lat"),
        ((F.lit(0.01) + F.col("value") / 5000.0) * 100.0 / grid_side(spark, sf_dir)).alias("half"),
    )


def footprints(spark: SparkSession, sf_dir: str, shape: str = "square") -> DataFrame:
    """Squares (or diamonds inscribed in them) as decoded footprints."""
    x, y, h = F.col("lon"), F.col("lat"), F.col("half")
    if shape == "square":
        rings = geo.box(x - h, y - h, x + h, y + h)
    else:
        rings = geo.single_ring(
            geo.point(x - h, y), geo.point(x, y - h), geo.point(x + h, y), geo.point(x, y + h),
            geo.point(x - h, y),
        )
    return squares(spark, sf_dir).select(
        "row_id",
        "uuid",
        "start_date",
        "end_date",
        rings.alias("rings"),
        geo.ring_edges(rings).alias("edges"),
        F.struct(
            (x - h).alias("xmin"), (y - h).alias("ymin"), (x + h).alias("xmax"), (y + h).alias("ymax")
        ).alias("extent"),
    )
