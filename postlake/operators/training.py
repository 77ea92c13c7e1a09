"""Self-training (G7-G10, U1, K5) as a driver loop of Spark jobs.

The reference fine-tunes a transformer on one machine, in epochs, and each round
goes on from the weights of the one before. Here the student is a softmax over
hashed words trained the same way (``student``): a step is a distributed pass, a
round has a few, and weights are carried on. A Spark ML pipeline (tokenise ->
hashed term frequencies -> IDF -> multinomial logistic regression), fitted anew
in each round, is the other choice. Every data step (pseudo-labelling, union,
evaluation) is a DataFrame job. The loop itself only carries a handful of
numbers for each step, and one model, on the driver.
"""

from __future__ import annotations

import time
from functools import reduce
from dataclasses import dataclass, field
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import (
    CONFIDENCE_THRESHOLD,
    FN_ITERATIONS,
    ID_TO_LABEL,
    MAX_TOKENS,
    SEED,
    THRESHOLD_CAP,
    THRESHOLD_STEP,
    TRAIN_BATCH_SIZE,
    TRAIN_EPOCHS,
    VALIDATION_FRACTION,
)
from ..functions.probs import label_id
from ..functions.text import is_blank, model_text, truncate_tokens
from .barrier import materialize
from .metrics import eval_metrics, tail_cut
from .sampling import order_key, sample_exact, stratified_split
from ..session import drop_path, is_folder, scratch_path
from .scoring import LOGITS, FeaturizedScorer, ModelScorer, Scorer, known_margins, pseudo_label
from .student import TOKENS, Student, StudentScorer, hashed_words, pack, train_steps

MODEL_INPUT = "__model_text"


def next_threshold(t: float, step: float = THRESHOLD_STEP, cap: float = THRESHOLD_CAP) -> float:
    """``min(cap, t + step)`` (so a start above the cap drops to it)."""
    return min(cap, t + step)


def threshold_schedule(start: float, iterations: int) -> list[float]:
    """Threshold used by each round; raised between rounds, not after the last."""
    out, t = [], float(start)
    for i in range(iterations):
        out.append(t)
        if i < iterations - 1:
            t = next_threshold(t)
    return out


def build_pipeline(
    label_col: str = "label_id",
    num_features: int = 1 << 16,
    max_iter: int = 50,
    reg_param: float = 1e-3,
    elastic_net: float = 0.0,
    use_idf: bool = True,
):
    """G7 student: RegexTokenizer -> HashingTF -> IDF -> multinomial LR.

    Each optimizer iteration aggregates a dense ``classes x num_features``
    gradient, so ``num_features`` sets the per-iteration cost; 2^16 buckets
    suit short posts and training sets of the documented size (thousands to
    tens of thousands of rows). Raise it for large vocabularies."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer

    stages = [
        RegexTokenizer(inputCol=MODEL_INPUT, outputCol="__tokens", pattern=r"\W+", toLowercase=True),
        HashingTF(inputCol="__tokens", outputCol="__tf" if use_idf else "__features", numFeatures=num_features),
    ]
    if use_idf:
        stages.append(IDF(inputCol="__tf", outputCol="__features"))
    stages.append(
        LogisticRegression(
            featuresCol="__features",
            labelCol=label_col,
            family="multinomial",
            maxIter=max_iter,
            regParam=reg_param,
            elasticNetParam=elastic_net,
            predictionCol="__prediction",
            probabilityCol="__probability",
            rawPredictionCol="rawPrediction",
        )
    )
    return Pipeline(stages=stages)


ROWS_PER_TRAIN_PARTITION = 100_000
TOKENS_PER_TRAIN_PARTITION = 1_000_000


def train_partitions(
    n_rows: int,
    n_tokens: int = 0,
    rows_per_partition: int = ROWS_PER_TRAIN_PARTITION,
    tokens_per_partition: int = TOKENS_PER_TRAIN_PARTITION,
) -> int:
    """Partitions for an optimizer pass, from the data alone.

    An iteration's work per row is proportional to its non-zero features
    (about its tokens), while every partition also returns one dense
    ``classes x features`` gradient. Partitions are sized so each holds about
    ``tokens_per_partition`` tokens (and at most ``rows_per_partition`` rows):
    long documents get several partitions even when they are few, and short
    posts do not pay a dense gradient per handful of rows.
    """
    return max(1, -(-n_rows // rows_per_partition), -(-n_tokens // tokens_per_partition))


TF_COL = "__tf_cached"
NTOK_COL = "__ntok"


def featurize(
    df: DataFrame, text_col: str = "text", keep: Sequence[str] = (), max_tokens: int | None = MAX_TOKENS, **params
) -> DataFrame:
    """The pipeline's tokenise + hash stages, once: ``keep`` columns plus the
    term-frequency vector (``TF_COL``) and the token count (``NTOK_COL``) of
    the first ``max_tokens`` tokens.

    Both stages are fixed functions of the text (no fitting), so a training
    loop can store these vectors once and fit / apply only the later stages
    every round."""
    tok, tf = build_pipeline(**params).getStages()[:2]
    x = df.select(*keep, _model_input(text_col, max_tokens).alias(MODEL_INPUT))
    y = tf.transform(tok.transform(x))
    return y.select(*keep, F.col(tf.getOutputCol()).alias(TF_COL), F.size("__tokens").alias(NTOK_COL))


def _model_input(text_col: str, max_tokens: int | None):
    text = model_text(text_col)
    return truncate_tokens(text, max_tokens) if max_tokens else text


def _class_label(label_col: str, n_classes: int):
    """The label as a double that says how many classes there are, so that a
    class without a training row keeps its place in the model."""
    meta = {"ml_attr": {"type": "nominal", "name": "label_id", "vals": [str(i) for i in range(n_classes)]}}
    return F.col(label_col).cast("double").alias("label_id", metadata=meta)


def train_classifier(
    df: DataFrame,
    text_col: str | None = "text",
    label_col: str = "label_id",
    featurized: bool = False,
    n_classes: int = len(ID_TO_LABEL),
    max_tokens: int | None = MAX_TOKENS,
    aggregation_depth: int = 2,
    report: dict | None = None,
    flag: str | None = None,
    **params,
):
    """Fit the student on ``(text, label_id)`` rows; returns a ModelScorer
    holding the whole text pipeline.

    Feature extraction runs on the input's own partitions (``featurized=True``:
    the rows already carry ``TF_COL`` and ``NTOK_COL`` from ``featurize``). The
    term frequencies are cached once, by the pass that counts rows and tokens;
    only the sparse feature vectors are then shuffled into ``train_partitions``
    partitions, which the optimizer's first pass caches. Each iteration
    aggregates one dense gradient per partition, in a tree of
    ``aggregation_depth`` levels (take 3 for thousands of partitions).

    ``report`` gets the rows, those with ``flag`` set, the tokens, and the loss
    and accuracy of the fitted model on its own training rows.
    """
    from pyspark.ml import PipelineModel

    tok, tf, *rest = build_pipeline(label_col="label_id", **params).getStages()
    *mid, lr = rest
    marked = (F.col(flag) if flag else F.lit(False)).alias("__flag")
    if featurized:
        cur = df.select(F.col(TF_COL).alias(tf.getOutputCol()), label_col, NTOK_COL, marked)
    else:
        x = featurize(df.withColumn("__flag", marked), text_col, [label_col, "__flag"], max_tokens, **params)
        cur = x.withColumnRenamed(TF_COL, tf.getOutputCol())
    held = [cur.persist(StorageLevel.MEMORY_AND_DISK)]
    try:
        stats = cur.agg(F.count(F.lit(1)).alias("n"), F.sum(NTOK_COL).alias("t"), F.count_if("__flag").alias("f")).first()
        cur = cur.withColumn("label_id", _class_label(label_col, n_classes))
        fitted = []
        for st in mid:  # IDF: one pass to fit, its transform feeds the optimizer
            m = st.fit(cur)
            fitted.append(m)
            cur = m.transform(cur)
        parts = train_partitions(int(stats["n"]), int(stats["t"] or 0))
        feats = cur.select(lr.getFeaturesCol(), "label_id").repartition(parts)
        held.append(feats.persist(StorageLevel.MEMORY_AND_DISK))
        lr_model = lr.copy().setAggregationDepth(aggregation_depth).fit(feats)
        scorer = ModelScorer(PipelineModel([tok, tf, *fitted, lr_model]), MODEL_INPUT, n_classes, max_tokens)
        if report is not None:
            margins = known_margins(vector_to_array(F.col("rawPrediction")), n_classes)
            own = eval_metrics(lr_model.transform(feats).select(margins.alias(LOGITS), F.col("label_id").cast("int").alias("label_id")), LOGITS, "label_id")
            report.update(rows=int(stats["n"]), flagged=int(stats["f"]), tokens=int(stats["t"] or 0), loss=own["loss"], accuracy=own["accuracy"])
    finally:
        for h in held:
            h.unpersist()
    return scorer


def on_features(scorer: Scorer) -> Scorer:
    """The scorer to use on ``featurize``d rows: a fitted student applies only
    its later stages; any other scorer (e.g. a teacher) reads the text."""
    if isinstance(scorer, StudentScorer):
        return StudentScorer(scorer.student, featurized=True)
    return FeaturizedScorer(scorer, TF_COL) if isinstance(scorer, ModelScorer) else scorer


def evaluate(
    scorer: Scorer,
    val: DataFrame,
    text_col: str = "text",
    label_col: str = "label_id",
    id_cols: Sequence[str] = ("doc_id",),
    batch_size: int = TRAIN_BATCH_SIZE,
    seed: int = SEED,
    cut: Column | None = None,
) -> dict:
    """Validation loss (row mean and batch-mean parity form) + accuracy. A
    row without a loss is an error. ``cut`` spares the scan that finds where the
    last batch may begin (``validation_cut``), for rows scored more than once."""
    scored = evaluation_rows(scorer, val, text_col)
    return eval_metrics(scored, LOGITS, label_col, order_key(list(id_cols), seed), batch_size, cut)


def validation_cut(val: DataFrame, id_cols: Sequence[str] = ("doc_id",), batch_size: int = TRAIN_BATCH_SIZE, seed: int = SEED) -> Column | None:
    """The ``cut`` of ``evaluate`` for ``val``: one key of one row."""
    if batch_size < 2:
        return None
    return F.lit(tail_cut(val, order_key(list(id_cols), seed), batch_size).first()["cut"]).cast("string")


def evaluation_rows(scorer: Scorer, val: DataFrame, text_col: str = "text") -> DataFrame:
    """``val`` with the logits of its stripped texts."""
    if isinstance(scorer, FeaturizedScorer) or getattr(scorer, "featurized", False):
        return scorer.add_logits(val, text_col)
    return scorer.add_logits(val.withColumn(MODEL_INPUT, model_text(text_col)), MODEL_INPUT)


class StepTrainer:
    """G7 in steps: ``epochs`` passes in a round, from the weights of the round before."""

    features = [TOKENS, NTOK_COL]

    def __init__(self, spark: SparkSession, epochs: int, batch_size: int, seed: int, n_classes: int, max_tokens: int | None, ids: Sequence[str], **params):
        self.spark, self.epochs, self.batch_size, self.seed, self.ids = spark, epochs, batch_size, seed, list(ids)
        self.rate = {k: params.pop(k) for k in ("rate",) if k in params}
        self.student = Student.new(n_classes, max_tokens=max_tokens, **params)

    def featurize(self, df: DataFrame, text_col: str, keep: Sequence[str]) -> DataFrame:
        words = hashed_words(_model_input(text_col, self.student.max_tokens), self.student.buckets)
        x = materialize(df.select(*dict.fromkeys([*keep, text_col])), {TOKENS: words})
        return x.select(*keep, TOKENS, F.size(TOKENS).alias(NTOK_COL))

    def fit(self, df: DataFrame, flag: str | None, validate) -> tuple[Scorer, Scorer, int, list[dict], dict]:
        """(last scorer, best scorer, best step, steps, counts); the next call goes on from the last."""
        paths = [scratch_path(self.spark, "train-rows"), scratch_path(self.spark, "train-blocks")]
        try:
            df.select(*self.ids, "label_id", *self.features, (F.col(flag) if flag else F.lit(False)).alias("__flag")).write.parquet(paths[0])
            rows = self.spark.read.parquet(paths[0])
            c = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("__flag").alias("flagged"), F.coalesce(F.sum(NTOK_COL), F.lit(0)).alias("tokens")).first()
            blocks, n = pack(rows, c["rows"], c["tokens"], self.ids, self.seed)
            blocks.write.parquet(paths[1])
            done = train_steps(self.spark.read.parquet(paths[1]), n, self.student, lambda s: validate(StudentScorer(s)), self.epochs, self.batch_size, seed=self.seed, **self.rate)
        finally:
            for path in paths:
                drop_path(self.spark, path)
        self.student = done.last
        return StudentScorer(done.last), StudentScorer(done.best), done.best_step, done.steps, c.asDict()


class MlTrainer:
    """G7 as one Spark ML fit in a round, from zero each time."""

    features = [TF_COL, NTOK_COL]

    def __init__(self, n_classes: int, max_tokens: int | None, **params):
        self.params, self.n_classes, self.max_tokens = params, n_classes, max_tokens

    def featurize(self, df: DataFrame, text_col: str, keep: Sequence[str]) -> DataFrame:
        return featurize(df, text_col, keep, self.max_tokens, **self.params)

    def fit(self, df: DataFrame, flag: str | None, validate) -> tuple[Scorer, Scorer, int, list[dict], dict]:
        own: dict = {}
        model = train_classifier(df, None, "label_id", True, self.n_classes, self.max_tokens, report=own, flag=flag, **self.params)
        found = validate(model)
        step = {"step": 1, "start_loss": None, "train_loss": own["loss"], "train_accuracy": own["accuracy"], **{f"val_{k}": v for k, v in found.items()}}
        return model, model, 1, [step], own


@dataclass
class SelfTrainResult:
    """``metrics``: a row for each round and step, ``best`` at the best step of its
    round. ``rounds`` has the last step of each round, with its best one."""

    scorer: Scorer
    metrics: DataFrame
    rounds: list[dict] = field(default_factory=list)
    best_round: int | None = None
    label_counts: dict[int, int] = field(default_factory=dict)
    steps: list[dict] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)


def without_labelled(unlabelled: DataFrame, labelled: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Leakage control: the unlabelled rows whose ``ids`` no labelled row has; a null
    id equals a null id."""
    known = labelled.select(*(F.col(c).alias(f"__known_{c}") for c in ids)).distinct()
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__known_{c}")) for c in ids))
    return unlabelled.join(known, same, "left_anti")


def prepare_labelled(
    labelled: DataFrame,
    label_col: str = "sentiment",
    size: int | None = None,
    id_cols: Sequence[str] = ("doc_id",),
    seed: int = SEED,
) -> DataFrame:
    """Sample first, then map names to ids and drop unknown labels (the
    reference's order); the text is not null-checked."""
    s = sample_exact(labelled, size, list(id_cols), seed)
    return s.withColumn("label_id", label_id(label_col)).filter(F.col("label_id").isNotNull())


def prepare_unlabelled(
    unlabelled: DataFrame,
    text_col: str = "text",
    size: int | None = None,
    id_cols: Sequence[str] = ("doc_id",),
    seed: int = SEED,
) -> DataFrame:
    """Drop null/blank texts first, then sample (the reference's order)."""
    f = unlabelled.filter(~is_blank(text_col))
    return sample_exact(f, size, list(id_cols), seed)


def combine_train(
    train: DataFrame, pseudo: DataFrame, text_col: str | None = "text", extra: Sequence[str] = ()
) -> DataFrame:
    """Train split + pseudo-labelled rows, duplicates kept (UNION ALL)."""
    cols = [*([text_col] if text_col else []), "label_id", *extra]
    return train.select(*cols).unionByName(pseudo.select(*cols))


def self_train(
    labelled: DataFrame,
    unlabelled: DataFrame,
    text_col: str = "text",
    label_col: str = "sentiment",
    id_cols: Sequence[str] = ("doc_id",),
    labelled_size: int | None = None,
    unlabelled_size: int | None = None,
    threshold: float = CONFIDENCE_THRESHOLD,
    iterations: int = FN_ITERATIONS,
    teacher: Scorer | None = None,
    output_dir: str | None = None,
    batch_size: int = TRAIN_BATCH_SIZE,
    keep: str = "last",
    exclude_labelled: bool = False,
    seed: int = SEED,
    test_size: float = VALIDATION_FRACTION,
    max_tokens: int | None = MAX_TOKENS,
    n_classes: int = len(ID_TO_LABEL),
    epochs: int | None = TRAIN_EPOCHS,
    **model_params,
) -> SelfTrainResult:
    """Split -> (pseudo-label -> union -> train -> evaluate) x n.

    Pseudo-labels do not accumulate: each round rescans the whole unlabelled
    set with the current model and rebuilds ``train + pseudo`` from the
    original train split. With no ``teacher`` the first pseudo-labelling model
    is fitted on the train split (no pre-trained weights exist here).

    A round has ``epochs`` steps and goes on from the weights that the round
    before ended with; a teacher that is a ``StudentScorer`` gives its weights to
    the first. After each step the validation rows are scored. ``epochs=None``
    fits a Spark ML pipeline from zero in each round instead.

    The best step (least mean of batch means, earliest on ties) counts anew in each
    round. ``keep='last'`` returns the weights after the last step and saves the
    last round's best step, as the reference does; ``keep='best'`` returns and
    saves the best step of all rounds.

    The split and the unlabelled set are tokenised and hashed once and written
    once, as Parquet in the shared folder, of which each round reads the columns
    it needs (a lost executor costs a re-read, not the joins and the
    tokenisation). The tables are deleted at the end. A teacher scorer reads the
    text, and every returned model is the whole text pipeline. ``label_counts``
    of the result has the rows of each class of the labelled set; its ``counts``
    are observed as those rows are written.
    """
    spark: SparkSession = labelled.sparkSession
    ids = list(id_cols)
    lab = prepare_labelled(labelled, label_col, labelled_size, ids, seed)
    unl = prepare_unlabelled(unlabelled, text_col, unlabelled_size, ids, seed)
    if exclude_labelled:
        unl = without_labelled(unl, lab, ids)
    if epochs is None:
        trainer: StepTrainer | MlTrainer = MlTrainer(n_classes, max_tokens, **model_params)
    else:
        trainer = StepTrainer(spark, epochs, batch_size, seed, n_classes, max_tokens, ids, **model_params)
        if isinstance(teacher, StudentScorer):
            trainer.student = teacher.student
    feat = trainer.features
    scratch: list[str] = []

    def stored(df: DataFrame, name: str) -> DataFrame:
        scratch.append(scratch_path(spark, name))
        df.write.parquet(scratch[-1])
        return spark.read.parquet(scratch[-1])

    try:
        # tokenise + hash once; every round reads the vectors
        lab_seen, unl_seen = Observation(), Observation()
        lab_in = stored(trainer.featurize(lab, text_col, [*ids, "label_id"]).observe(lab_seen, F.count(F.lit(1)).alias("n")), "self-train-labelled")
        split = stratified_split(lab_in, "label_id", ids, test_size, seed)  # a comparison of id hashes per row
        # only a teacher that reads text needs the unlabelled texts
        text = [text_col] if teacher is not None and on_features(teacher) is teacher else []
        unl = stored(trainer.featurize(unl, text_col, [*ids, *text]).observe(unl_seen, F.count(F.lit(1)).alias("n")), "self-train-unlabelled")
        train = split.where("is_train").select(*ids, "label_id", *feat)
        val = split.where(~F.col("is_train")).select(*ids, "label_id", *feat)
        counts = split.groupBy("label_id").agg(F.count_if("is_train").alias("train"), F.count_if(~F.col("is_train")).alias("val")).collect()  # one row a class
        labels = {int(r["label_id"]): int(r["train"] + r["val"]) for r in counts}
        n_train, n_val = (sum(int(r[c]) for r in counts) for c in ("train", "val"))
        n_unl = int(unl_seen.get["n"])
        if epochs is not None:  # each step reads the validation rows: flagged once
            val = stored(val, "self-train-validation")
        cut = validation_cut(val, ids, batch_size, seed)  # the same rows in every step
        spent = [0.0]

        def validate(scorer: Scorer) -> dict:
            t = time.perf_counter()
            found = evaluate(on_features(scorer), val, text_col, "label_id", ids, batch_size, seed, cut)
            spent[0] += time.perf_counter() - t
            return {"loss": found["loss"], "loss_batch_mean": found.get("loss_batch_mean", found["loss"]), "accuracy": found["accuracy"]}

        marked = train.withColumn("pseudo", F.lit(False))
        current = teacher or trainer.fit(marked, None, lambda scorer: {})[0] if epochs is not None else teacher or train_classifier(train, None, "label_id", True, n_classes, max_tokens, **model_params)

        rounds: list[dict] = []
        steps: list[dict] = []
        best: tuple[float, int, Scorer] | None = None
        for i, t in enumerate(threshold_schedule(threshold, iterations)):
            # one scoring pass over the whole unlabelled set per round; its rows go straight into the fit
            t0, spent[0] = time.perf_counter(), 0.0
            source = unl if text and current is teacher else unl.drop(*text)
            pseudo = pseudo_label(source, on_features(current), t, text_col).select(*ids, "label_id", *feat)
            combined = combine_train(marked, pseudo.withColumn("pseudo", F.lit(True)), None, [*ids, *feat, "pseudo"])
            current, top, top_step, found, own = trainer.fit(combined, "pseudo", validate)
            fixed = {
                "round": i + 1,
                "threshold": float(t),
                "unlabelled": n_unl,
                "pseudo": int(own["flagged"]),
                "pseudo_percent": (own["flagged"] * 100.0 / n_unl) if n_unl else 0.0,
                "train": n_train,
                "combined": int(own["rows"]),
                "validation": n_val,
            }
            steps += [{**fixed, **s, "best": s["step"] == top_step} for s in found]
            rounds.append({**steps[-1], "best_step": top_step, "sec_fit": time.perf_counter() - t0 - spent[0], "sec_evaluate": spent[0]})
            loss = found[top_step - 1]["val_loss_batch_mean"]
            if best is None or loss < best[0]:
                best = (loss, i + 1, top)

        chosen = best[2] if (keep == "best" and best is not None) else current
        if output_dir:
            save_model(chosen if keep == "best" else top if rounds else current, output_dir)
    finally:
        for path in scratch:
            drop_path(spark, path)
    return SelfTrainResult(
        scorer=chosen,
        metrics=metrics_frame(spark, steps),
        rounds=rounds,
        best_round=best[1] if best else None,
        label_counts=labels,
        steps=steps,
        counts={"labelled": int(lab_seen.get["n"]), "unlabelled": n_unl, **{f"accepted_{r['round']}": r["pseudo"] for r in rounds}},
    )


METRICS_SCHEMA = (
    "round int, step int, threshold double, unlabelled long, pseudo long, pseudo_percent double, train long, combined long, validation long, "
    "start_loss double, train_loss double, train_accuracy double, val_loss double, val_loss_batch_mean double, val_accuracy double, best boolean"
)


def metrics_frame(spark: SparkSession, steps: list[dict]) -> DataFrame:
    """One row per round and step (a small report: rounds x epochs)."""
    names = [c.split()[0] for c in METRICS_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(s[n] for n in names) for s in steps], METRICS_SCHEMA)


def save_model(scorer: Scorer, path: str) -> None:
    """K5: persist the chosen model (overwrite): a student's weights as a Parquet
    table, a pipeline with the Spark ML writer."""
    if isinstance(scorer, StudentScorer):
        scorer.student.save(SparkSession.active(), path)
        return
    model = getattr(scorer, "model", None)
    if model is None:
        raise TypeError("only a trained student or a fitted Spark ML model can be saved")
    model.write().overwrite().save(path)


def load_model(path: str, n_classes: int = len(ID_TO_LABEL), max_tokens: int | None = MAX_TOKENS) -> Scorer:
    """The scorer that ``save_model`` wrote to ``path``."""
    from pyspark.ml import PipelineModel

    spark = SparkSession.active()
    if is_folder(spark, f"{path.rstrip('/')}/stages"):
        return ModelScorer(PipelineModel.load(path), MODEL_INPUT, n_classes, max_tokens)
    return StudentScorer(Student.load(spark, path))
