"""Fitting classifiers and predicting cells and objects."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landspark.operators.samples import balanced_weights, decode_labels, encode_labels, label_encoder
from landspark.sources.shared import materialize

NODATA = -9999


class Classifier:
    """A fitted pipeline and the encoder of its labels."""

    def __init__(self, pipeline: PipelineModel, encoder: DataFrame, features: list[str]):
        self.pipeline, self.encoder, self.features = pipeline, encoder, features

    def save(self, path: str) -> None:
        """Writes the pipeline, the encoder and the names of features; replaces what is there."""
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        self.encoder.coalesce(1).write.mode("overwrite").parquet(f"{path}/encoder")
        spark = self.encoder.sparkSession
        spark.createDataFrame(list(enumerate(self.features)), "place int, feature string").coalesce(1).write.mode("overwrite").parquet(f"{path}/features")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Classifier:
        features = [r["feature"] for r in spark.read.parquet(f"{path}/features").orderBy("place").collect()]
        return cls(PipelineModel.load(f"{path}/pipeline"), spark.read.parquet(f"{path}/encoder"), features)

    def predict(self, df: DataFrame, out: str = "class_code") -> DataFrame:
        """Adds the predicted label; map-only but for the broadcast of one row per class."""
        found = self.pipeline.transform(df).withColumn("_code", F.col("prediction").cast("int"))
        return decode_labels(found.select(*df.columns, "_code"), self.encoder, "_code", out).drop("_code")


def fit_classifier(
    samples: DataFrame, features: list[str], label: str = "label", trees: int = 500, depth: int = 8, subsample: float = 0.8, step: float = 0.03, seed: int = 0, boosted: bool = False, columns: str = "auto"
) -> Classifier:
    """Fits trees to samples, each weighted by the inverse share of its class.

    A random forest by default; ``boosted`` takes one-against-rest boosted trees.
    ``columns`` is the share of features that a split may choose from, as Spark's
    ``featureSubsetStrategy`` states it ("0.8"); boosted trees have no penalty on leaf
    weights in Spark, so that parameter has no counterpart. NaN and null features are
    invalid and must not occur.
    """
    # samples are read in many passes, so what they are derived from is computed once
    samples = materialize(samples.filter(F.col(label).isNotNull()).select(*features, label), "samples")
    encoder = materialize(label_encoder(samples, label), "encoder")
    rows = balanced_weights(encode_labels(samples, encoder, label, "_enc"), "_enc", "_weight")
    rows = rows.withColumn("_enc", F.col("_enc").cast("double"))
    assembler = VectorAssembler(inputCols=features, outputCol="_features")
    if boosted:
        one = GBTClassifier(featuresCol="_features", labelCol="_enc", weightCol="_weight", maxIter=trees, maxDepth=depth, stepSize=step, subsamplingRate=subsample, featureSubsetStrategy=columns, seed=seed)
        trained = OneVsRest(classifier=one, featuresCol="_features", labelCol="_enc", weightCol="_weight")
    else:
        trained = RandomForestClassifier(featuresCol="_features", labelCol="_enc", weightCol="_weight", numTrees=trees, maxDepth=depth, subsamplingRate=subsample, featureSubsetStrategy=columns, seed=seed)
    return Classifier(Pipeline(stages=[assembler, trained]).fit(rows), encoder, features)


def fit_or_load(spark: SparkSession, path: str, samples: DataFrame, features: list[str], **settings) -> Classifier:
    """The classifier stored at ``path``, fitted and stored first if there is none."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/features/_SUCCESS")
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        fit_classifier(samples, features, **settings).save(path)
    return Classifier.load(spark, path)


def predict_cells(cells: DataFrame, model: Classifier, nodata: int = NODATA) -> DataFrame:
    """``row_id, col_id, class_code``; cells with NaN, null or nodata in a feature get nodata. Map-only."""
    ok = F.lit(True)
    for f in model.features:
        ok &= F.col(f).isNotNull() & ~F.isnan(f) & (F.col(f) != nodata)
    # all cells go through the model in one pass, so what they are derived from is not computed twice
    found = model.predict(cells.select("row_id", "col_id", ok.alias("_ok"), *[F.when(ok, F.col(f)).otherwise(F.lit(0).cast(cells.schema[f].dataType)).alias(f) for f in model.features]))
    return found.select("row_id", "col_id", F.when(F.col("_ok"), F.col("class_code").cast("int")).otherwise(F.lit(nodata)).alias("class_code"))


def predict_objects(matrix: DataFrame, model: Classifier) -> DataFrame:
    """``seg_id, class_code`` of every segment."""
    return model.predict(matrix).select("seg_id", F.col("class_code").cast("int"))


def from_array(df: DataFrame, col: str, n: int, prefix: str = "f") -> tuple[DataFrame, list[str]]:
    """``df`` with the array column ``col`` as ``n`` columns, and their names."""
    names = [f"{prefix}{k}" for k in range(n)]
    array = vector_to_array(col) if dict(df.dtypes)[col] == "vector" else F.col(col)
    return df.select(*[c for c in df.columns if c != col], *[array[k].alias(names[k]) for k in range(n)]), names
