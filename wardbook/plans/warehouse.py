"""The models and the folder they are built into."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wardbook.plans import core, flags, marts, staging
from wardbook.schema import RAW_SCHEMA
from wardbook.sources.folders import written
from wardbook.sources.versions import current, publish


@dataclass(frozen=True)
class Model:
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    is_view: bool = False


RAW = "raw"

# Model names, what each reads, and which one stays a view.
MODELS = {
    "stg_311_requests": Model(staging.stage_requests, (RAW,)),
    "dim_date": Model(core.dim_date, ("stg_311_requests",)),
    "dim_location": Model(core.dim_location, ("stg_311_requests",)),
    "dim_agency": Model(core.dim_agency, ("stg_311_requests",)),
    "dim_complaint_type": Model(core.dim_complaint_type, ("stg_311_requests",)),
    "dim_status": Model(core.dim_status, ("stg_311_requests",)),
    "dim_channel": Model(core.dim_channel, ("stg_311_requests",)),
    "fct_311_complaint": Model(core.fct_complaint, ("stg_311_requests",)),
    "fct_311_complaint_text": Model(core.fct_complaint_text, ("stg_311_requests",)),
    "int_complaints_flagged": Model(
        flags.complaints_flagged, ("fct_311_complaint", "dim_status"), is_view=True
    ),
    "fct_daily_metrics": Model(marts.daily_metrics, ("int_complaints_flagged",)),
    "fct_monthly_metrics": Model(marts.monthly_metrics, ("int_complaints_flagged",)),
    "fct_borough_complaint_mix": Model(
        marts.borough_mix, ("int_complaints_flagged", "dim_location", "dim_complaint_type")
    ),
}
STAGING = ["stg_311_requests"]
CORE = [name for name, model in MODELS.items() if model.inputs == ("stg_311_requests",)]
MARTS = ["fct_daily_metrics", "fct_monthly_metrics", "fct_borough_complaint_mix"]
BUILD_THREADS = 4
MODEL_FOLDER = "models"


class Warehouse:
    """Model tables over one raw input, each written once when first asked for.

    A warehouse writes to a build folder of its own under root. Nothing that is
    published changes until publish(), which makes all tables of the build the current
    ones at once.
    """

    def __init__(self, root: str, raw: DataFrame):
        self.root = root.rstrip("/")
        self.build = f"build-{uuid.uuid4().hex}"
        self._frames: dict[str, DataFrame] = {RAW: raw}

    @classmethod
    def opened(cls, spark: SparkSession, root: str) -> Warehouse:
        """The published tables, as they were written; nothing is built."""
        build = (current(spark, f"{root.rstrip('/')}/{MODEL_FOLDER}") or {}).get("build")
        if build is None:
            raise RuntimeError(f"There is no published warehouse at {root}")
        found = cls(root, spark.createDataFrame([], RAW_SCHEMA))
        found.build = build
        for name, model in MODELS.items():
            if not model.is_view:
                found._frames[name] = spark.read.parquet(found.path(name))
        return found

    def path(self, name: str) -> str:
        return f"{self.root}/{MODEL_FOLDER}/{self.build}/{name}"

    def plan(self, name: str) -> DataFrame:
        """The model over its inputs, not written itself."""
        model = MODELS[name]
        return model.build(*[self.table(i) for i in model.inputs])

    def table(self, name: str) -> DataFrame:
        """The written model; its file sizes then guide the joins that read it."""
        if name not in self._frames:
            frame = self.plan(name)
            if not MODELS[name].is_view:
                frame = written(frame, self.path(name))
            self._frames[name] = frame
        return self._frames[name]

    def build_all(self) -> dict[str, DataFrame]:
        """Write every table, layer by layer; tables of one layer run side by side."""
        with ThreadPoolExecutor(BUILD_THREADS) as pool:
            for layer in (STAGING, CORE, MARTS):
                list(pool.map(self.table, layer))
        return {name: self.table(name) for name in MODELS}

    def publish(self) -> None:
        """Make this build, which must be complete, the published one."""
        spark = self._frames[RAW].sparkSession
        publish(spark, f"{self.root}/{MODEL_FOLDER}", {"build": self.build})

    def create_views(self) -> None:
        """Temp views under the model names, for SQL."""
        for name in MODELS:
            self.table(name).createOrReplaceTempView(name)
