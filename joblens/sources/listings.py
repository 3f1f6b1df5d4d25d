"""``listings``: raw job postings derived from ``orders``.

No driver table holds postings, so every query and oracle derives the same
rows from ``orders``: one listing per order, five sites, six salary formats
per site, experience and address texts that exercise every cleaning rule.
The derivation is a narrow projection (no shuffle), so it scales with the
orders scan and keeps the scan's partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.salary import SOURCES
from .tables import read_table, spread

# The texts of the derived postings (FIXTURES.md section 3).
ADDRESSES = (
    "Hà Nội",
    "Hà Nội & Hồ Chí Minh",
    "Đà Nẵng, Cần Thơ",
    "Hồ Chí Minh\nBình Dương",
    "Bà Rịa - Vũng Tàu",
    "Cần Thơ,",
)

# Salary formats per site (FIXTURES.md section 3), six variants each, as
# templates: {a} {b} are amounts in millions, {u1} {u2} USD amounts with
# thousands separators.
SALARY_TEMPLATES = {
    "topcv": ("Thoả thuận", "Tới {b} triệu", "Tới {u1} USD", "{a} - {b} triệu", "{u1} - {u2} USD", "Trên {a} triệu"),
    "careerlink": ("Thương lượng", "{a} triệu", "Trên {a} triệu", "{a} triệu - {b} triệu", "{u1} USD - {u2} USD", "Trên {u1} USD"),
    "careerviet": ("Lương: Cạnh tranh", "Lương: Trên {a} Tr VND", "Lương: Lên đến {b} Tr VND",
                   "Lương: {a} Tr - {b} Tr VND", "Lương: {u1} - {u2} USD", "Lương: Trên {u1} USD"),
    "itviec": ("Sign in to view salary",) * 6,
    "vietnamworks": ("Thương lượng", "Tới {u1} USD", "{a} - {b} triệu", "{u1} - {u2} USD", "Tới $ {u1} /tháng", "{a}tr-{b}tr ₫/tháng"),
}
EXP_TEMPLATES = ("Không yêu cầu", "{y} năm", "Dưới 1 năm", "Trên 5 năm")

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice"]


def _at(values, index: Column) -> Column:
    """``values[index]`` for a 0-based index into a constant list (the
    array literal is folded once; only the lookup runs per row)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _fill(template: Column, **values: Column) -> Column:
    out = template
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def _derivation() -> tuple[list[Column], list[Column]]:
    """The two projections of the derivation (over ``orders`` columns)."""
    base = [
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("c"),
        F.col("o_orderpriority").alias("p"),
        F.col("o_orderdate").cast("date").alias("query_day"),
        (F.floor(F.col("o_totalprice") / 10000).cast("bigint") + 1).alias("a"),
        F.expr("o_orderkey % 5").alias("site"),
        F.expr("(o_orderkey div 5) % 6").alias("variant"),
        F.expr("(o_orderkey div 3) % 5 + 1").alias("exp_years"),
        F.expr("(o_orderkey div 7) % 6").alias("address_pick"),
        F.expr("(o_orderkey div 11) % 4").alias("exp_pick"),
    ]
    k, a, v, site = F.col("k"), F.col("a"), F.col("variant"), F.col("site")
    templates = [t for name in SOURCES for t in SALARY_TEMPLATES[name]]
    salary = _fill(
        _at(templates, site * 6 + v),
        a=a.cast("string"),
        b=(a + 1 + k % 10).cast("string"),
        u1=F.format_number(a * 100, 0),
        u2=F.format_number(a * 100 + 500, 0),
    )
    out = [
        k.alias("listing_id"),
        v.alias("variant"),
        F.col("query_day"),
        _at(SOURCES, site).alias("source"),
        F.concat(F.lit("Kỹ sư "), F.col("p")).alias("position"),
        F.concat(F.lit("Công ty "), F.col("c").cast("string")).alias("company"),
        _at(ADDRESSES, F.col("address_pick")).alias("address"),
        _fill(_at(EXP_TEMPLATES, F.col("exp_pick")), y=F.col("exp_years").cast("string")).alias("exp"),
        salary.alias("salary"),
    ]
    return base, out


_CACHE: dict = {}


def listings_from_orders(orders: DataFrame) -> DataFrame:
    """orders -> (listing_id, variant, query_day, source, position, company,
    address, exp, salary); narrow projections only.  The expressions are
    built once per Spark application (they are immutable and reusable)."""
    app = orders.sparkSession.sparkContext.applicationId
    if app not in _CACHE:
        _CACHE.clear()
        _CACHE[app] = _derivation()
    base, out = _CACHE[app]
    return orders.select(*base).select(*out)


def read_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings over the pruned ``orders`` scan.  Cleaning is CPU-bound
    (regex splits per row), so a scan with fewer splits than cores is
    spread first; a big input already has enough splits and is left as is."""
    return listings_from_orders(spread(read_table(spark, sf_dir, "orders", ORDER_COLUMNS)))
