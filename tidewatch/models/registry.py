"""Stored models, the registry of versions, and the log of training runs.

A model is a folder `{root}/{yyyy-MM-dd_HH-mm-ss}`; registry and run log are append-only parquet tables.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

import pyspark
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.models.training import Candidate
from tidewatch.operators.reports import latest

FOLDER_TIME = "%Y-%m-%d_%H-%M-%S"
METADATA_SCHEMA = "ml_name string, folder string, performance string, hyperparameters string, library_versions string, timestamp string"
REGISTRY_SCHEMA = "model_name string, folder string, version int, stage string, auc_test double, registered_at timestamp"
RUN_SCHEMA = "run_id string, name string, started_at timestamp, params map<string,string>, metrics map<string,double>"


def _append(spark: SparkSession, rows: list, schema: str, path: str) -> None:
    """A folder of its own for every append: writers of one folder share its staging area, and the first of them to
    commit would take away that of the others."""
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{uuid.uuid4().hex}")


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def save_model(spark: SparkSession, candidate: Candidate, performance: dict, root: str,
               now: dt.datetime | None = None) -> str:
    """Write the fitted pipeline and a metadata row; returns the folder name. A folder that is there already,
    from a run in the same second, is an error: stored models are never replaced."""
    now = now or dt.datetime.now()
    folder = now.strftime(FOLDER_TIME)
    candidate.model.write().save(f"{root}/{folder}/model")
    learner = candidate.model.stages[-1]
    settings = {p.name: v for p, v in learner.extractParamMap().items()} | dict(candidate.settings)
    row = (candidate.family, folder, json.dumps(performance, default=str),
           json.dumps(settings, default=str), json.dumps({"pyspark": pyspark.__version__}),
           now.strftime("%Y-%m-%d %H:%M:%S"))
    _append(spark, [row], METADATA_SCHEMA, f"{root}/_models")
    return folder


def load_latest(spark: SparkSession, root: str) -> tuple[PipelineModel | None, dict | None]:
    """The newest stored model and its metadata; (None, None) when there is none."""
    found = latest(_table(spark, f"{root}/_models", METADATA_SCHEMA)).collect()
    if not found:
        return None, None
    metadata = found[0].asDict()
    for name in ("performance", "hyperparameters", "library_versions"):
        metadata[name] = json.loads(metadata[name])
    return PipelineModel.load(f"{root}/{metadata['folder']}/model"), metadata


def log_run(spark: SparkSession, path: str, run_id: str, name: str, params: dict, metrics: dict) -> None:
    """Append one training run: settings as texts, metrics as numbers."""
    numbers = {k: float(v) for k, v in metrics.items() if isinstance(v, (int, float)) and v is not None}
    row = (run_id, name, dt.datetime.now(), {k: str(v) for k, v in params.items()}, numbers)
    _append(spark, [row], RUN_SCHEMA, path)


def runs(spark: SparkSession, path: str) -> DataFrame:
    """The logged training runs."""
    return _table(spark, path, RUN_SCHEMA)


def registry(spark: SparkSession, root: str) -> DataFrame:
    return _table(spark, f"{root}/_registry", REGISTRY_SCHEMA)


def _claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file that must not be there yet; False where it is. One of several callers succeeds: local
    files are created exclusively, stores behind Hadoop's file systems by create without overwrite."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(where.getParent())
    try:
        if store.getScheme() == "file":
            plain = store.makeQualified(where).toUri().getPath()
            jvm.java.nio.file.Files.createFile(jvm.java.io.File(plain).toPath(), spark.sparkContext._gateway.new_array(
                jvm.java.nio.file.attribute.FileAttribute, 0))
        else:
            store.create(where, False).close()
    except Py4JJavaError as error:
        if "AlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def promote(spark: SparkSession, root: str, model_name: str, folder: str | None, auc_test: float | None) -> int:
    """Register a candidate as the next production version and return its number. Without a champion
    nothing changes: earlier versions stay, and the call is an error. The number is claimed by a file of its own before
    the row is written, so runs that promote at the same moment get different numbers."""
    if folder is None:
        raise ValueError("no champion to promote; production keeps its model")
    known = registry(spark, root).where(F.col("model_name") == model_name)
    version = (known.agg(F.max("version")).first()[0] or 0) + 1
    while not _claim(spark, f"{root}/_claims/{model_name}-{version}"):
        version += 1
    _append(spark, [(model_name, folder, version, "produccion", auc_test, dt.datetime.now())],
            REGISTRY_SCHEMA, f"{root}/_registry")
    return version


def production_folder(spark: SparkSession, root: str, model_name: str) -> str | None:
    """Folder of the version in production: the highest number, the last registered of equal ones."""
    known = registry(spark, root).where(F.col("model_name") == model_name)
    row = known.orderBy(F.desc("version"), F.desc("registered_at")).select("folder").first()
    return row["folder"] if row else None


def load_production(spark: SparkSession, root: str, model_name: str) -> PipelineModel | None:
    folder = production_folder(spark, root, model_name)
    return PipelineModel.load(f"{root}/{folder}/model") if folder else None
