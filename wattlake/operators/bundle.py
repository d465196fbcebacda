"""Everything that scoring needs from training, saved and loaded as one versioned folder.

``path/version=N/`` holds the encoders (a ``PipelineModel``), one
``PipelineModel`` per meter, the training mean area per meter, and a manifest
that is written last: a version without a manifest is an unfinished save and is
never loaded.  ``load`` takes the newest finished version unless told otherwise.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

FORMAT = 1
AREA_COLUMN = "__mean_square_feet"


@dataclass
class ModelBundle:
    encoders: PipelineModel
    models: Mapping[int, PipelineModel]
    mean_area: DataFrame                      # (meter, __mean_square_feet), one row per meter
    features: Sequence[str] = field(default_factory=list)
    version: int | None = None

    def save(self, spark: SparkSession, path: str) -> int:
        """Write the next version under ``path``; returns its number."""
        version = max(versions(spark, path), default=0) + 1
        base = f"{path.rstrip('/')}/version={version}"
        self.encoders.write().overwrite().save(f"{base}/encoders")
        for meter, model in self.models.items():
            model.write().overwrite().save(f"{base}/models/meter={meter}")
        self.mean_area.write.mode("overwrite").parquet(f"{base}/mean_area")
        manifest = {"format": FORMAT, "version": version, "meters": sorted(self.models), "features": list(self.features)}
        spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(
            f"{base}/manifest")
        self.version = version
        return version


def _manifests(spark: SparkSession, path: str) -> list[dict]:
    """The manifests of all finished versions (one short line each)."""
    try:
        rows = spark.read.text(f"{path.rstrip('/')}/version=*/manifest").collect()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return [json.loads(r["value"]) for r in rows]


def versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions under ``path``."""
    return sorted(m["version"] for m in _manifests(spark, path))


def load(spark: SparkSession, path: str, version: int | None = None) -> ModelBundle:
    """The newest finished version, or the one asked for."""
    found = {m["version"]: m for m in _manifests(spark, path)}
    if not found or (version is not None and version not in found):
        raise FileNotFoundError(f"no finished model version{'' if version is None else f' {version}'} under {path}")
    m = found[max(found) if version is None else version]
    if m["format"] != FORMAT:
        raise ValueError(f"model format {m['format']} of version {m['version']} is not {FORMAT}")
    base = f"{path.rstrip('/')}/version={m['version']}"
    return ModelBundle(PipelineModel.load(f"{base}/encoders"),
                       {k: PipelineModel.load(f"{base}/models/meter={k}") for k in m["meters"]},
                       spark.read.parquet(f"{base}/mean_area"), m["features"], m["version"])
