"""The ledger and access-log views over the driver tables (FIXTURES.md §2).

* ``ledger``      – integer-cent transactions ledger from ``orders`` + ``customer``
* ``raw_ledger``  – the same with DECIMAL(18,2) money, in the reference's column order
* ``pool``        – deterministic decoys: 10 % of legitimate rows, amount perturbed
* ``pool_zoned``  – pool rows with their placement zone and content hash
* ``injected``    – ledger ∪ pool with ``is_decoy``, ``zone`` and a dense ``pos``
* ``access_log``  – who read which ``pos`` of ``injected`` (from ``events``)
* ``scores``      – a classifier-output stand-in with many ties (from the ledger)

Every view is a lazy DataFrame; joins are left to Catalyst/AQE (the customer
dimension is broadcast only when AQE measures it small).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.functions.hashing import hash_rows
from tripwire.operators.models import even_rows
from tripwire.operators.ranking import first_n, global_rank, int_range_bucket, scalar
from tripwire.schema import CONTENT_CENTS, MONEY_CENTS, ZONES
from tripwire.session import materialize
from tripwire.sources.tables import table

# FIXED VALUES of the fixture ledger (priority -> transaction type).
PRIORITY_TYPE = [("1-URGENT", "TRANSFER"), ("2-HIGH", "CASH_OUT"),
                 ("3-MEDIUM", "PAYMENT"), ("4-NOT SPECIFIED", "CASH-IN")]
OTHER_TYPE = "DEBIT"


def _cents(x: Column) -> Column:
    return F.round(x * 100).cast("bigint")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer-cent ledger, one row per order (``tx_id`` = ``o_orderkey``)."""
    orders = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    n_cust = F.lit(scalar(cust.select(F.count(F.lit(1)))))
    d = F.col("o_orderdate")
    prio = F.col("o_orderpriority")
    ttype = F.lit(OTHER_TYPE)
    for p, t in reversed(PRIORITY_TYPE):
        ttype = F.when(prio == p, F.lit(t)).otherwise(ttype)
    total_c = _cents(F.col("o_totalprice"))
    b = orders.select(
        F.col("o_orderkey").alias("tx_id"),
        (F.lit(1) + (F.year(d) * 372 + F.month(d) * 31 + F.dayofmonth(d)) % 744).cast("int").alias("step"),
        ttype.alias("type"),
        ((total_c - total_c % 50) / 50).cast("bigint").alias("amt_c"),
        F.col("o_custkey").alias("orig"),
        ((F.col("o_custkey") * 7 + 3) % n_cust).alias("dest"),
        F.col("o_orderstatus").alias("st"),
    )
    bal = F.when(F.col("c_acctbal") > 0, _cents(F.col("c_acctbal"))).otherwise(F.lit(0).cast("bigint"))
    co = cust.select(F.col("c_custkey").alias("orig"), bal.alias("ob_c"))
    cd = cust.select(F.col("c_custkey").alias("dest"), bal.alias("od_c"))
    b = b.join(co, "orig").join(cd, "dest")
    amt, ob, od = F.col("amt_c"), F.col("ob_c"), F.col("od_c")
    return b.select(
        "tx_id", "step", "type",
        amt.alias("amount_c"),
        F.concat(F.lit("C"), F.col("orig").cast("string")).alias("nameOrig"),
        ob.alias("oldbalanceOrg_c"),
        F.when(ob > amt, ob - amt).otherwise(F.lit(0).cast("bigint")).alias("newbalanceOrig_c"),
        F.concat(F.lit("C"), F.col("dest").cast("string")).alias("nameDest"),
        od.alias("oldbalanceDest_c"),
        (od + F.when(F.col("tx_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(amt)).alias("newbalanceDest_c"),
        F.when(F.col("type").isin("TRANSFER", "CASH_OUT") & (amt >= ob) & (F.col("st") == "F")
               & (F.col("tx_id") % 10 < 6), 1).otherwise(0).alias("isFraud"),
        F.when(amt > 900000, 1).otherwise(0).alias("isFlaggedFraud"),
    )


def to_money(c: str) -> Column:
    """Cents -> DECIMAL(18,2), exactly."""
    return (F.col(c).cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def raw_ledger(led: DataFrame) -> DataFrame:
    """The reference's raw schema (DECIMAL money), keyed by ``tx_id``. Rows
    without names/labels (decoys) get NULL names and label 0."""
    col = lambda c, default: F.col(c) if c in led.columns else default
    return led.select(
        "tx_id", "step", "type", to_money("amount_c").alias("amount"),
        col("nameOrig", F.lit(None).cast("string")).alias("nameOrig"),
        to_money("oldbalanceOrg_c").alias("oldbalanceOrg"),
        to_money("newbalanceOrig_c").alias("newbalanceOrig"),
        col("nameDest", F.lit(None).cast("string")).alias("nameDest"),
        to_money("oldbalanceDest_c").alias("oldbalanceDest"),
        to_money("newbalanceDest_c").alias("newbalanceDest"),
        col("isFraud", F.lit(0)).alias("isFraud"), col("isFlaggedFraud", F.lit(0)).alias("isFlaggedFraud"))


def pool(led: DataFrame, seed: int = 42, fraction_div: int = 10) -> DataFrame:
    """Deterministic decoys: first floor(n_legit/10) legitimate rows by md5(tx_id:seed),
    re-keyed past the ledger and with a perturbed amount."""
    n_all = F.lit(scalar(led.select(F.count(F.lit(1)))))
    legit = led.filter(F.col("isFraud") == 0)
    donors = first_n(legit, "tx_id", seed, lambda tot: F.floor(tot / F.lit(float(fraction_div))))
    return donors.select(
        (F.col("tx_id") + n_all).alias("tx_id"), "step", "type",
        (F.col("amount_c") + 1 + F.col("tx_id") % 997).alias("amount_c"),
        "oldbalanceOrg_c", "newbalanceOrig_c", "oldbalanceDest_c", "newbalanceDest_c")


def zone_of(key: Column) -> Column:
    z = F.lit(ZONES[-1])
    for i in reversed(range(len(ZONES) - 1)):
        z = F.when(key % len(ZONES) == i, F.lit(ZONES[i])).otherwise(z)
    return z


#: Salt of the fixtures; callers of the library pass their own.
FIXTURE_SALT = "pepper"


def pool_zoned(pl: DataFrame, salt: str = FIXTURE_SALT) -> DataFrame:
    return hash_rows(pl.withColumn("zone", zone_of(F.col("tx_id"))), CONTENT_CENTS, salt)


def injected(led: DataFrame, pz: DataFrame) -> DataFrame:
    """Ledger ∪ zoned pool, each row with ``is_decoy``, ``zone`` and ``pos`` (0-based,
    ``tx_id`` order, computed with the bucketed global rank)."""
    real = led.select(*(["tx_id"] + CONTENT_CENTS), "isFraud",
                      F.lit(False).alias("is_decoy"), F.lit(None).cast("string").alias("zone"))
    fake = pz.select(*(["tx_id"] + CONTENT_CENTS), F.lit(0).alias("isFraud"),
                     F.lit(True).alias("is_decoy"), "zone")
    u = real.unionByName(fake)
    ranked = global_rank(u, F.col("tx_id"), [], bucket=int_range_bucket(u, "tx_id"), out="pos")
    return ranked.withColumn("pos", F.col("pos") - 1)


def access_log(spark: SparkSession, sf_dir: str, inj: DataFrame) -> DataFrame:
    """Who read which injected row: ``batch`` = day of month of the access."""
    n_inj = F.lit(scalar(inj.select(F.count(F.lit(1)))))
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.col("user_id").alias("actor"), "ts",
                     F.dayofmonth("ts").cast("int").alias("batch"),
                     ((F.col("event_id") * 7919) % n_inj).alias("pos"))


def scores(led: DataFrame) -> DataFrame:
    """Classifier output stand-in with many tied scores."""
    return led.select("tx_id", F.col("isFraud").alias("label"),
                      (F.col("amount_c") % 1000 + 300 * F.col("isFraud")).alias("score"))


class Views:
    """All fixture views for one scale-factor directory.

    ``ledger``, ``pool_zoned`` and ``injected`` are materialised tables (the
    real system writes its injected table and lookup once and serves reads
    from them); ``access`` stays a lazy scan of ``events``.
    """

    _cache: dict = {}

    def __init__(self, spark: SparkSession, sf_dir: str, salt: str = FIXTURE_SALT):
        self.spark, self.sf_dir, self.salt = spark, sf_dir, salt
        self.ledger = even_rows(materialize(ledger(spark, sf_dir)))
        self.raw = raw_ledger(self.ledger)
        self.pool = pool(self.ledger)
        self.pool_zoned = materialize(pool_zoned(self.pool, salt))
        self.pool_raw = raw_ledger(self.pool_zoned)
        self.injected = materialize(injected(self.ledger, self.pool_zoned))
        self.access = access_log(spark, sf_dir, self.injected)
        self.scores = scores(self.ledger)

    @classmethod
    def get(cls, spark: SparkSession, sf_dir: str, salt: str = FIXTURE_SALT) -> "Views":
        """Views shared by the queries of one Spark application."""
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), salt)
        v = cls._cache.get(key)
        if v is None:
            v = cls._cache[key] = cls(spark, sf_dir, salt)
        return v

    def memo(self, name: str, build):
        """Build a derived table once per view set (callers materialise it)."""
        memo = self.__dict__.setdefault("_memo", {})
        if name not in memo:
            memo[name] = build()
        return memo[name]

    def lookup(self) -> DataFrame:
        from tripwire.operators.lookup import register
        return register(self.pool_zoned)
