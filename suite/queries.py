"""One registered query per operator, each over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.functions.materialize import new_folder
from tabloom.functions.order import row_index
from tabloom.functions.rng import uniform
from tabloom.operators import boxcox as bc
from tabloom.operators import energy as en
from tabloom.operators import generate as gn
from tabloom.operators import impute, likelihood, lines, losses, missing, moments, network, onehot, ranking, scaler, splits, target
from tabloom.operators import quadrants as qd
from tabloom.plans.generate import generate
from tabloom.plans.postprocess import postprocess
from tabloom.plans.preprocess import preprocess, read_stats, write_preprocessed
from tabloom.sources import roles, tables, training_log
from tabloom.sources.roles import Roles
from tabloom.sources.stats import ColumnStats

from .fixtures import (
    CAPPED, CATEGORIES, CHECKPOINTS, DOMAIN_A, DOMAIN_B, DUMP, DUMP_FEATURES, GRID, HEADER, LINES, LOG, NUMERIC, PARTS,
    TRAIN, read, tiny_net, view,
)

KEY = "o_orderkey"
LAMBDA_STEP = 0.01
NBOOT = 19
BOXCOX_COLS = ["price", "bal", "rare_null", "const"]
SCALE_COLS = ["price", "bal", "rare_null", "few", "const"]


def rounded(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Doubles rounded for comparison, without a negative zero."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            (F.round(F.col(f"`{c}`"), special.get(c, digits)) + F.lit(0.0)).alias(c) if kinds[c] == "double" else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def stats_rows(spark: SparkSession, stats: ColumnStats, fields: dict[str, str], digits: int = 6) -> DataFrame:
    """One row per fitted column with the named statistics."""
    rows = [(c, *[s.get(f) for f in fields]) for c, s in stats.columns.items()]
    schema = "col string, " + ", ".join(f"`{f}` {t}" for f, t in fields.items())
    return rounded(spark.createDataFrame(rows, schema), digits)


def train(spark, d) -> DataFrame:
    return view(spark, d, TRAIN)


# ---- sources -------------------------------------------------------------------------------


def read_typed_table(spark, d):
    header = Roles({"o_orderkey": "K", "o_orderstatus": "C", "o_orderpriority": "C", "o_totalprice": "N", "o_custkey": "N"})
    return roles.read_typed_table(spark, f"{d}/orders.parquet", header, "parquet")


def read_columns(spark, d):
    return tables.read_columns(spark, f"{d}/lineitem.parquet", ["l_quantity", "l_extendedprice"])


def draw_minibatches(spark, d):
    return tables.draw_minibatches(read(spark, d, "orders").select(KEY), KEY, 500, 5_000, 2, seed=7)


def sample_rows(spark, d):
    return tables.sample_rows(read(spark, d, "orders").select(KEY, "o_totalprice"), 512, KEY, seed=11)


def perturb_rows(spark, d):
    df = view(spark, d, GRID).join(read(spark, d, "orders").select(KEY, "o_orderstatus"), KEY)
    return rounded(tables.perturb_rows(df.select(KEY, "o_orderstatus", "n1", "n2"), ["n1", "n2"], KEY, "o_orderstatus", seed=3))


def write_shuffled(spark, d):
    return row_index(read(spark, d, "orders").select(KEY), tables.shuffle_order(KEY, 5), "pos")


def restore_layout(spark, d):
    return tables.restore_layout(train(spark, d), ["unq1", "price", "status", "target", "absent"], [KEY])


def parse_training_log(spark, d):
    return training_log.parse_training_log(view(spark, d, LOG))


def best_checkpoint(spark, d):
    return training_log.best_checkpoint(
        training_log.parse_training_log(view(spark, d, LOG)), training_log.checkpoint_iterations(view(spark, d, CHECKPOINTS))
    )


def loss_trace(spark, d):
    losses_ = read(spark, d, "orders").select(
        (F.col(KEY) + 1).alias("iter"), (F.col("o_totalprice") / 1e6).alias("G_loss"), (F.col("o_custkey") / 1e3).alias("D_loss")
    )
    return rounded(training_log.loss_trace(losses_, 100), 11)


# ---- categorical ---------------------------------------------------------------------------


def onehot_fit(spark, d):
    stats = onehot.onehot_fit(train(spark, d), CATEGORIES, KEY)
    rows = [(c, pos, v, s["type"]) for c, s in stats.columns.items() for pos, v in enumerate(s["values"])]
    return spark.createDataFrame(rows, "col string, pos int, value string, type string")


MANY = ["l_partkey", "l_suppkey"]


def onehot_vocabulary(spark, d):
    return onehot.onehot_vocabulary(read(spark, d, "lineitem"), MANY, "l_orderkey")


def onehot_index(spark, d):
    df = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *MANY)
    return onehot.onehot_index(df, onehot.onehot_vocabulary(df, MANY, "l_orderkey"), MANY)


def onehot_index_back(spark, d):
    df = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *MANY)
    vocabulary = onehot.onehot_vocabulary(df, MANY, "l_orderkey")
    return onehot.onehot_index_back(onehot.onehot_index(df, vocabulary, MANY), vocabulary, MANY)


def onehot_fit_transform(spark, d):
    return onehot.onehot_fit_transform(train(spark, d).select(KEY, *CATEGORIES), CATEGORIES, KEY)[0]


def onehot_transform(spark, d):
    df = train(spark, d).select(KEY, *CATEGORIES)
    stats = onehot.onehot_fit(df, CATEGORIES, KEY)
    other = df.withColumn("segment", F.when(F.col("segment") == "BUILDING", "OTHER").otherwise(F.col("segment")))
    return onehot.onehot_transform(other, stats)[0]


def onehot_back(spark, d):
    encoded, _, stats = onehot.onehot_fit_transform(train(spark, d).select(KEY, *CATEGORIES), CATEGORIES, KEY)
    return onehot.onehot_back(encoded, stats)


def laplace_fit(spark, d):
    stats = likelihood.laplace_fit(train(spark, d), "target", ["status", "segment"])
    return rounded(stats.table.withColumn("global_avg", F.lit(stats.global_avg)))


def laplace_fit_transform(spark, d):
    df = train(spark, d).select(KEY, "status", "segment", "target")
    return rounded(likelihood.laplace_fit_transform(df, "target", ["status", "segment"])[0])


def laplace_transform(spark, d):
    df = train(spark, d).select(KEY, "status", "segment", "target")
    stats = likelihood.laplace_fit(df, "target", ["status", "segment"])
    other = df.withColumn("segment", F.when(F.col("segment") == "BUILDING", "OTHER").otherwise(F.col("segment")))
    return rounded(likelihood.laplace_transform(other, stats, ["status", "segment", "flag01"], replace=False))


def center_target(spark, d):
    return target.center_target(train(spark, d).select(KEY, "target"), ["target"])


def uncenter_target(spark, d):
    df = train(spark, d).select(KEY, (F.col("price") / 250000.0 - 1.0).alias("target"))
    return target.uncenter_target(df, ["target"])


# ---- missing and special values --------------------------------------------------------------


def missing_fit_transform(spark, d):
    return missing.missing_fit_transform(train(spark, d).select(KEY, *NUMERIC), NUMERIC)[0]


def missing_transform(spark, d):
    df = train(spark, d).select(KEY, *NUMERIC)
    stats = missing.missing_fit(df, NUMERIC)
    other = df.withColumn("bal", F.when(F.col("price") > 250000.0, F.col("bal")))
    return missing.missing_transform(other, stats)[0]


def _with_flags(df: DataFrame, *names: str) -> DataFrame:
    """Random flag columns, as a generator would give them."""
    return df.select("*", *[(uniform(17, n, KEY) - F.lit(0.5)).alias(n) for n in names])


def missing_back(spark, d):
    df = train(spark, d).select(KEY, *NUMERIC)
    stats = missing.missing_fit(df, NUMERIC)
    filled = impute.impute_zero(df, ["bal"]).select(KEY, "bal")
    return missing.missing_back(_with_flags(filled, "bal_missing"), stats, KEY, ["bal"]).select(KEY, "bal")


def special_fit_transform(spark, d):
    return missing.special_fit_transform(train(spark, d).select(KEY, *NUMERIC), NUMERIC)[0]


def special_transform(spark, d):
    df = train(spark, d).select(KEY, *NUMERIC)
    stats = missing.special_fit(df, NUMERIC)
    other = df.withColumn("spike", F.when(F.col("price") > 250000.0, F.col("spike")).otherwise(F.lit(0.0)))
    return missing.special_transform(other, stats)[0]


def special_back(spark, d):
    stats = missing.special_fit(train(spark, d).select(KEY, *NUMERIC), NUMERIC, "majority")
    made = train(spark, d).select(KEY, F.col("price").alias("spike"), F.col("price").alias("bal"))
    flagged = _with_flags(made, "spike_highfreq", "bal_missing")
    return missing.special_back(flagged, stats, KEY, ["spike", "bal"]).select(KEY, "spike", "bal")


def impute_median(spark, d):
    return rounded(impute.impute_median(train(spark, d).select(KEY, "bal", "rare_null"), ["bal", "rare_null"]))


def impute_zero(spark, d):
    return impute.impute_zero(train(spark, d).select(KEY, "bal", "rare_null"), ["bal", "rare_null"])


def impute_random(spark, d):
    return impute.impute_random(train(spark, d).select(KEY, "bal", "rare_null"), ["bal", "rare_null"], KEY, seed=13)


def impute_model(spark, d):
    df = train(spark, d).select(KEY, "price", "bal", "rare_null", "target")
    return impute.impute_model(df, ["bal", "rare_null"], ["price", "bal", "rare_null", "target"])


def impute_model_step(spark, d):
    """A column that is a step of one feature: without a penalty, each round closes a hundredth of the rest."""
    step = F.when(F.col(KEY) % 10 != 3, F.when(F.col("few") >= 10, 7.0).otherwise(3.0)).alias("step")
    df = train(spark, d).select(KEY, "price", "few", "bal", step)
    return impute.impute_model(df, ["step"], ["price", "few", "bal", "step"], penalty=0.0).select(KEY, F.round("step", 6).alias("step"))


def impute_model_facts(spark, d):
    """What must hold of the filled table: every observed cell as it was, no cell left empty."""
    before = train(spark, d).select(KEY, F.col("bal").alias("bal0"), F.col("rare_null").alias("rare_null0"))
    both = impute_model(spark, d).join(before, KEY)
    facts = [
        both.agg(
            F.lit(c).alias("col"),
            F.count("*").alias("rows"),
            F.count_if(F.col(f"{c}0").isNull()).alias("filled"),
            F.count_if(F.col(c).isNull()).alias("empty"),
            F.count_if(F.col(f"{c}0").isNotNull() & (F.col(c) != F.col(f"{c}0"))).alias("changed"),
        )
        for c in ("bal", "rare_null")
    ]
    return facts[0].unionByName(facts[1])


# ---- numeric transforms ----------------------------------------------------------------------


def _boxcox_stats(spark, d):
    return bc.boxcox_fit(train(spark, d), BOXCOX_COLS, resolution=LAMBDA_STEP)


def boxcox_fit(spark, d):
    fields = {f: "double" for f in ("median", "min", "max", "std", "shift", "lambd")}
    return stats_rows(spark, _boxcox_stats(spark, d), fields, 5)


def boxcox_fit_search(spark, d):
    """The library's own search, without a grid."""
    cols = [c for c in BOXCOX_COLS if c != "const"]
    return stats_rows(spark, bc.boxcox_fit(train(spark, d), cols), {"lambd": "double"}, 2)


def boxcox_fit_transform(spark, d):
    df = train(spark, d).select(KEY, *BOXCOX_COLS)
    out, _ = bc.boxcox_fit_transform(df, BOXCOX_COLS, resolution=LAMBDA_STEP)
    return rounded(out, 4, price=2)


def boxcox_transform(spark, d):
    df = train(spark, d).select(KEY, *[(F.col(c) - F.lit(1000.0)).alias(c) for c in BOXCOX_COLS[:3]])
    return rounded(bc.boxcox_transform(df, _boxcox_stats(spark, d)), 4, price=2)


def boxcox_back(spark, d):
    stats = _boxcox_stats(spark, d)
    df = bc.boxcox_transform(train(spark, d).select(KEY, *BOXCOX_COLS), stats)
    stretched = df.select(KEY, *[(F.col(c) * F.lit(1.25)).alias(c) for c in BOXCOX_COLS])
    return rounded(bc.boxcox_back(stretched, stats), 5, price=2)


def boxcox_hist(spark, d):
    return bc.boxcox_hist(train(spark, d), _boxcox_stats(spark, d), BOXCOX_COLS[:3])


def scaler_fit(spark, d):
    fields = {"scaling_type": "string", **{f: "double" for f in ("median", "mean", "std", "max", "min")}}
    events = scaler.scaler_fit(read(spark, d, "events"), ["value"])
    return stats_rows(spark, scaler.scaler_fit(train(spark, d), SCALE_COLS).updated(events), fields, 5)


def scaler_fit_transform(spark, d):
    return rounded(scaler.scaler_fit_transform(train(spark, d).select(KEY, *SCALE_COLS), SCALE_COLS)[0])


def scaler_transform(spark, d):
    events = read(spark, d, "events").select("event_id", "value")
    stats = scaler.scaler_fit(events, ["value"])
    return rounded(scaler.scaler_transform(events.withColumn("value", F.col("value") * 2.0), stats))


def scaler_back(spark, d):
    df = train(spark, d).select(KEY, *SCALE_COLS)
    scaled, stats = scaler.scaler_fit_transform(df, SCALE_COLS)
    return rounded(scaler.scaler_back(scaled, stats))


def _split_stats(spark, d):
    return splits.splitcap_fit(view(spark, d, DUMP), DUMP_FEATURES, DUMP_FEATURES)


def splitcap_fit(spark, d):
    return stats_rows(spark, _split_stats(spark, d), {"min_split": "double", "max_split": "double"})


def splitcap_fit_transform(spark, d):
    return rounded(splits.splitcap_fit_transform(view(spark, d, CAPPED), view(spark, d, DUMP), DUMP_FEATURES)[0])


def splitcap_transform(spark, d):
    return rounded(splits.splitcap_transform(view(spark, d, CAPPED), _split_stats(spark, d), ["rare_null", "flag"]))


def splitcap_back(spark, d):
    stats = _split_stats(spark, d)
    return rounded(splits.splitcap_back(splits.splitcap_transform(view(spark, d, CAPPED), stats), stats), 4)


def svd_standardize(spark, d):
    df = read(spark, d, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])
    return rounded(moments.svd_standardize(df, [f"e{i}" for i in range(64)], 8))


def svd_spectrum(spark, d):
    """Power sums of all squared singular values: their sum, and those of squares and cubes as shares of it."""
    names = [f"e{i}" for i in range(64)]
    df = read(spark, d, "embeddings").select(*[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(names)])
    squares = moments.svd_basis(df, names, 64)[0] ** 2
    total = squares.sum()
    rows = [(k, float(total if k == 1 else ((squares / total) ** k).sum())) for k in (1, 2, 3)]
    return rounded(spark.createDataFrame(rows, "power int, value double"))


def svd_facts(spark, d):
    """Mean and deviation of each component over all rows."""
    scores = svd_standardize(spark, d)
    each = [c for c in scores.columns if c.startswith("svd_")]
    long = scores.unpivot([], each, "component", "score")
    found = long.groupBy("component").agg(F.count("*").alias("rows"), F.avg("score").alias("mean"), F.stddev_pop("score").alias("deviation"))
    return rounded(found, 4)


# ---- generation ------------------------------------------------------------------------------

GENERATOR = dict(first_layer=1, inputs=4, outputs=2)
CRITIC = dict(first_layer=3, inputs=4, outputs=1)
DATA, CONDITIONS = ["n1", "n2"], ["g1", "g2"]


def grid(spark, d) -> DataFrame:
    return view(spark, d, GRID)


def sample_noise(spark, d):
    return rounded(gn.sample_noise(read(spark, d, "orders").select(KEY), 3, KEY, seed=2))


def dense_forward(spark, d):
    out = network.dense_forward(grid(spark, d), tiny_net(**GENERATOR), DATA + CONDITIONS, ["o1", "o2"], how="batches")
    return rounded(out.select(KEY, "o1", "o2"))


def generate_unconditional(spark, d):
    given = grid(spark, d)
    net = moments.fit_generator(given, DATA, [])  # means and covariance of the given rows
    return rounded(gn.generate_unconditional(spark, tables.count_rows(given), net, DATA, 2, seed=21))


def generate_conditional(spark, d):
    rows = 2 * tables.count_rows(read(spark, d, "orders")) + 7
    return rounded(gn.generate_conditional(grid(spark, d), tiny_net(**GENERATOR), DATA, CONDITIONS, [KEY], rows, 2, seed=22))


def generate_pinned(spark, d):
    rows = tables.count_rows(read(spark, d, "orders")) + 7
    return rounded(gn.generate_pinned(grid(spark, d), tiny_net(**GENERATOR), DATA, CONDITIONS, [KEY], rows, 2, "g1", seed=23))


def generate_uniform(spark, d):
    rows = tables.count_rows(read(spark, d, "orders"))
    return rounded(gn.generate_uniform(grid(spark, d), tiny_net(**GENERATOR), DATA, CONDITIONS, rows, 2, seed=24))


def translate_a_to_b(spark, d):
    rows = tables.count_rows(read(spark, d, "orders"))
    return rounded(gn.translate_a_to_b(grid(spark, d), tiny_net(5, 2, 2), DATA, ["b1", "b2"], KEY, rows))


def reconstruction_error(spark, d):
    df = grid(spark, d).withColumn("lift_ind", F.col("g1") + 0.5)
    return rounded(
        gn.reconstruction_error(df, tiny_net(**GENERATOR), DATA, CONDITIONS, KEY, 2, seed=25, ids=["lift_ind"], pinned="g2", agg="min")
    )


def _scored(spark, d) -> DataFrame:
    rows = tables.count_rows(read(spark, d, "orders"))
    made = gn.generate_conditional(grid(spark, d), tiny_net(**GENERATOR), DATA, CONDITIONS, [KEY], rows, 2, seed=26)
    made = made.withColumnRenamed("id", KEY)
    return losses.score_realness(grid(spark, d), made, tiny_net(**CRITIC), DATA + CONDITIONS, KEY)


def score_realness(spark, d):
    return rounded(_scored(spark, d))


def realness_auc(spark, d):
    return rounded(losses.realness_auc(_scored(spark, d)))


def bce_loss(spark, d):
    return rounded(losses.bce_loss(_scored(spark, d)))


def lsgan_loss(spark, d):
    return rounded(losses.lsgan_loss(_scored(spark, d)))


def critic_gap(spark, d):
    return rounded(losses.critic_gap(_scored(spark, d)))


def _domains(spark, d):
    return (view(spark, d, DOMAIN_A), view(spark, d, DOMAIN_B), tiny_net(5, 2, 2), tiny_net(7, 2, 2), ["a1", "a2"], ["b1", "b2"])


def cycle_error(spark, d):
    return rounded(losses.cycle_error(*_domains(spark, d)))


def identity_error(spark, d):
    return rounded(losses.identity_error(*_domains(spark, d)))


def cycle_total(spark, d):
    a, b, a_to_b, _, a_cols, b_cols = domains = _domains(spark, d)
    made = gn.translate_a_to_b(a, a_to_b, a_cols, b_cols, "p_partkey", a.count()).withColumnRenamed("p_partkey", "k")
    scored = losses.score_realness(b.withColumnRenamed("s_suppkey", "k"), made, tiny_net(9, 2, 1), b_cols, "k")
    parts = losses.lsgan_loss(scored), losses.cycle_error(*domains), losses.identity_error(*domains)
    return rounded(losses.cycle_total(*parts, cycle_lambd=10.0))


def fit_generator(spark, d):
    return rounded(moments.fit_generator(grid(spark, d), ["n1"], ["g1"]).weights_frame(spark))


# ---- evaluation ------------------------------------------------------------------------------


def _scores(spark, d) -> DataFrame:
    return train(spark, d).select(
        KEY, "target", "price", (F.col("price") / 5e5).alias("pred"), F.floor(F.col("price") / 5000.0).alias("tied"),
        (F.lit(1.0) + F.col("target")).alias("weight"), (F.coalesce("bal", F.lit(0.0)) + 1000.0).alias("truth"),
    )


def jsd(spark, d):
    s = _scores(spark, d)
    low, high = s.agg(F.min("price"), F.max("price")).first()
    sides = [ranking.histogram(s.where(F.col("target") == t), F.col("price"), low, high, 50) for t in (1.0, 0.0)]
    return rounded(ranking.jsd(*sides))


def gini_binary(spark, d):
    return rounded(ranking.gini_binary(_scores(spark, d), "target", "tied"))


def gini(spark, d):
    return rounded(ranking.gini(_scores(spark, d), "truth", "tied", KEY))


def capture_rate(spark, d):
    return rounded(ranking.capture_rate(_scores(spark, d), "target", "tied", KEY, at=5.0, sample_size=25.0))


def tree_importance(spark, d):
    return rounded(splits.tree_importance(view(spark, d, DUMP), DUMP_FEATURES))


def accuracy_index(spark, d):
    return rounded(ranking.accuracy_index(_scores(spark, d), "target", "pred", KEY, "weight"))


def diagonal_cmv(spark, d):
    return rounded(lines.diagonal_cmv(view(spark, d, LINES), "final_line", "opt_line", "cmv", KEY))


def parts(spark, d) -> DataFrame:
    return view(spark, d, PARTS)


def quadrant_counts(spark, d):
    return rounded(qd.quadrant_counts(parts(spark, d), "sample", "x", "y", 1))


def maxdist(spark, d):
    return rounded(qd.maxdist(parts(spark, d), "sample", "x", "y", 1))


def avgmaxdist(spark, d):
    return rounded(qd.avgmaxdist(parts(spark, d), "sample", "x", "y", 1))


def ks2d(spark, d):
    return rounded(qd.ks2d(parts(spark, d), "sample", "x", "y", 1))


def ks2d_bootstrap(spark, d):
    return rounded(qd.ks2d_bootstrap(parts(spark, d), "sample", "x", "y", 1, "p_partkey", NBOOT, seed=31))


def _vectors(spark, d) -> DataFrame:
    return read(spark, d, "embeddings").select("vec_id", "embedding", F.when(F.col("label") < 5, 1).otherwise(2).alias("sample"))


def energy(spark, d):
    return rounded(en.energy(_vectors(spark, d), "sample", "embedding", "vec_id", 1))


def estat(spark, d):
    return rounded(en.estat(_vectors(spark, d), "sample", "embedding", "vec_id", 1, nboot=NBOOT, seed=32))


def estat2d(spark, d):
    return rounded(en.estat2d(parts(spark, d), "sample", "x", "y", "p_partkey", 1, nboot=NBOOT, method="linear", seed=33))


# ---- whole jobs ------------------------------------------------------------------------------


def preprocess_pipeline(spark, d):
    return rounded(preprocess(train(spark, d), HEADER, resolution=LAMBDA_STEP, checkpoint_input=True).table)


def generate_pipeline(spark, d):
    header = Roles({KEY: "", "n1": "N", "n2": "N", "g1": "G", "g2": "G"})
    return rounded(
        generate(
            grid(spark, d), header, lambda it: tiny_net(**GENERATOR, shift=(it % 7) / 10.0), 2, [KEY],
            log_lines=view(spark, d, LOG), files=view(spark, d, CHECKPOINTS), how="g1", seed=27,
        )
    )


def postprocess_pipeline(spark, d):
    done = preprocess(train(spark, d), HEADER, resolution=LAMBDA_STEP, checkpoint_input=True)
    original = Roles({"unq1": "K", **{c: r for c, r in HEADER.roles.items() if r != "K"}})
    return rounded(postprocess(done.table, original, done.stats, KEY), 4, price=2, bal=2, spike=2, rare_null=6)


def _files(spark, d) -> tuple:
    """The preprocess job's files, written and read back: the shuffled table with its types, its header and the statistics."""
    done = preprocess(train(spark, d), HEADER, resolution=LAMBDA_STEP, checkpoint_input=True)
    folder = new_folder(spark)
    write_preprocessed(spark, done, folder, KEY, seed=41)
    header = roles.read_role_header(spark, f"{folder}/scaled_header")
    if header.roles != done.roles.roles:
        raise ValueError(f"the header came back as {header.roles}")
    table = roles.read_typed_table(spark, f"{folder}/scaled", header)
    return table.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in done.table.dtypes]), read_stats(spark, folder)


def preprocess_files(spark, d):
    return rounded(_files(spark, d)[0])


def postprocess_files(spark, d):
    table, stats = _files(spark, d)
    original = Roles({"unq1": "K", **{c: r for c, r in HEADER.roles.items() if r != "K"}})
    return rounded(postprocess(table, original, stats, KEY), 4, price=2, bal=2, spike=2, rare_null=6)


def whole_chain_facts(spark, d):
    """Preprocess, fit a generator, make as many rows, bring them back: what must hold of any rows made so."""
    done = preprocess(train(spark, d), HEADER, resolution=LAMBDA_STEP, checkpoint_input=True)
    net = moments.fit_generator(done.table, done.roles.numerical, done.roles.conditions)
    made = generate(done.table, done.roles, lambda it: net, len(done.roles.numerical), [KEY], using_iter=1, seed=43)
    original = Roles({"unq1": "K", **{c: r for c, r in HEADER.roles.items() if r != "K"}})
    out = postprocess(made, original, done.stats, "id", numbered=True)
    low, high = (done.stats["boxcox"].columns["price"][k] for k in ("min", "max"))
    return out.agg(
        F.count("*").alias("rows"),
        F.count_distinct("unq1").alias("ids"),
        F.min("unq1").alias("first_id"),
        # a value whose inverse transform is not real is NULL too
        (F.count_if(F.col("bal").isNull()) >= F.round(F.lit(done.stats["special"].columns["bal"]["nmissing"]) * F.count("*"))).alias("missing"),
        F.count_if(~F.col("price").between(low, high)).alias("outside"),
        F.count_if(F.col("const") == 1).alias("constant"),
        F.count_distinct("segment").alias("segments"),
        F.count_distinct("status").alias("statuses"),
    )


NAMES = """
read_typed_table read_columns draw_minibatches sample_rows perturb_rows write_shuffled restore_layout parse_training_log
best_checkpoint loss_trace
onehot_fit onehot_vocabulary onehot_index onehot_index_back onehot_fit_transform onehot_transform onehot_back laplace_fit laplace_fit_transform laplace_transform
center_target uncenter_target
missing_fit_transform missing_transform missing_back special_fit_transform special_transform special_back
impute_median impute_zero impute_random impute_model impute_model_step impute_model_facts
boxcox_fit boxcox_fit_search boxcox_fit_transform boxcox_transform boxcox_back boxcox_hist scaler_fit scaler_fit_transform scaler_transform
scaler_back splitcap_fit splitcap_fit_transform splitcap_transform splitcap_back svd_standardize svd_spectrum svd_facts
sample_noise dense_forward generate_unconditional generate_conditional generate_pinned generate_uniform translate_a_to_b
reconstruction_error score_realness realness_auc bce_loss lsgan_loss critic_gap cycle_error identity_error cycle_total
fit_generator
jsd gini_binary gini capture_rate tree_importance accuracy_index diagonal_cmv quadrant_counts maxdist avgmaxdist ks2d
ks2d_bootstrap energy estat estat2d
preprocess_pipeline generate_pipeline postprocess_pipeline preprocess_files postprocess_files whole_chain_facts
""".split()

QUERIES = {name: globals()[name] for name in NAMES}
