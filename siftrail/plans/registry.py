"""Models, parameters and promoted baselines: small things, kept on the driver."""

from __future__ import annotations

import hashlib
import json
import shutil
from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftrail.sources.datasets import load_mapping

REQUIRED = {"yolo": ("asset_id",), "rtmdet": ("asset_id",), "rfdetr": ("asset_id", "variant")}
NEED_CONFIG = ("rtmdet", "mmdet")


def deep_merge(base: dict, over: dict) -> dict:
    """``over`` laid on ``base``, mapping by mapping; neither is changed."""
    out = dict(base)
    for k, v in over.items():
        out[k] = deep_merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def model_settings(params: dict, key: str) -> dict[str, Any]:
    """A model's own settings over its backend's defaults over the shared ones of training."""
    models = params.get("models") or {}
    if key not in models:
        raise ValueError(f"unknown model {key!r}; known are {sorted(models)}")
    own = models[key]
    check_model(key, own)
    shared = {k: v for k, v in (params.get("train") or {}).items() if not isinstance(v, dict) and k != "model"}
    backend = (params.get("models_defaults") or {}).get(own["backend"]) or {}
    return deep_merge(deep_merge(shared, backend), own)


def check_model(key: str, own: dict) -> None:
    backend = own.get("backend")
    if backend not in REQUIRED:
        raise ValueError(f"model {key!r} has backend {backend!r}; supported are {sorted(REQUIRED)}")
    if missing := [f for f in REQUIRED[backend] if not own.get(f)]:
        raise ValueError(f"model {key!r} lacks {missing}")


def backend_differences(params: dict) -> tuple[set[str], set[str]]:
    """Backends configured but not supported, and supported but not configured."""
    configured = {m.get("backend") for m in (params.get("models") or {}).values()}
    return configured - set(REQUIRED), set(REQUIRED) - configured


def model_table(spark: SparkSession, params: dict) -> DataFrame:
    """(model_key, backend, asset_id, overrides) of all configured models."""
    rows = [(k, m.get("backend"), m.get("asset_id"), {o: json.dumps(v) for o, v in m.items() if o not in ("backend", "asset_id")}) for k, m in (params.get("models") or {}).items()]
    return spark.createDataFrame(rows, "model_key string, backend string, asset_id string, overrides map<string,string>")


def precedence(models: DataFrame, defaults: DataFrame, shared: dict[str, Any], fields: Sequence[str]) -> DataFrame:
    """Each model's fields: its own value, else its backend's, else the shared one."""
    d = defaults.select("backend", *[F.col(f).alias(f"d_{f}") for f in fields])
    joined = models.join(d, "backend", "left")
    return joined.select("model_key", "backend", *[F.coalesce(F.col(f), F.col(f"d_{f}"), F.lit(shared.get(f))).alias(f) for f in fields])


def with_project_defaults(argv: Sequence[str], root: str) -> list[str]:
    """Command-line arguments with stage, workspace and configuration added unless given."""
    given = {a.split("=", 1)[0] for a in argv if a.startswith("--")}
    out = list(argv)
    for flag, value in (("--stage", "train"), ("--workspace-root", root), ("--config", str(Path(root) / "params.yaml"))):
        if flag not in given:
            out += [flag, value]
    return out


# Promotion.


@dataclass(frozen=True)
class Source:
    weights: Path
    metadata: Path
    run_dir: Path | None


def resolved(path: str | None, root: Path) -> Path | None:
    """A path as it stands, or below ``root`` if it is relative; none for nothing."""
    if not path:
        return None
    p = Path(path).expanduser()
    return p if p.is_absolute() else root / p


def default_baseline(params: dict, root: Path) -> Path:
    found = resolved((params.get("evaluation") or {}).get("baseline_weights_path"), root)
    if found is None:
        raise ValueError("evaluation.baseline_weights_path is not configured and no baseline path was given")
    return found


def find_source(root: Path, run_dir: str | None = None, weights: str | None = None, metadata: str | None = None) -> Source:
    """Weights and metadata as given, or from the places they have in a run's folder."""
    run = resolved(run_dir, root)
    w = resolved(weights, root) or (run / "weights" / "best.pt" if run else None)
    m = resolved(metadata, root) or (run / "metadata.yaml" if run else None)
    for what, found in (("weights", w), ("metadata", m)):
        if found is None:
            raise ValueError(f"{what} must be given, or a run's folder that has them")
        if not found.exists():
            raise FileNotFoundError(f"no {what} at {found}")
    return Source(w, m, run)


def required_metadata(path: Path) -> dict:
    data = load_mapping(str(path))
    if not str(data.get("model_backend") or "").strip():
        raise ValueError(f"{path} must define model_backend")
    return data


def config_artifact(data: dict, source: Source, root: Path) -> Path | None:
    """The model's configuration file, for backends that need one: as the metadata names it
    (absolute, beside the metadata, below the root), or else in the run's folder."""
    if str(data["model_backend"]).strip().lower() not in NEED_CONFIG:
        return None
    named = str(data.get("model_config_path") or "").strip()
    places = []
    if named:
        p = Path(named).expanduser()
        places = [p] if p.is_absolute() else [source.metadata.parent / p, root / p]
    if source.run_dir:
        places.append(source.run_dir / "model_config.py")
    found = next((p for p in places if p.exists()), None)
    if found is None:
        raise FileNotFoundError("this backend needs its model_config.py beside the metadata or in the run's folder")
    return found


def _below(path: Path, root: Path) -> str:
    return str(path.relative_to(root)) if path.is_relative_to(root) else str(path)


def promote(root: str, run_dir: str | None = None, weights: str | None = None, metadata: str | None = None, baseline: str | None = None, tag: str | None = None, params: dict | None = None) -> tuple[Path, Path]:
    """Copy a run's weights to the baseline's place and write its metadata beside them.

    Everything is checked before anything is copied. The run of origin is noted if the metadata has
    none yet, the weights of origin always.
    """
    base = Path(root)
    target = resolved(baseline, base) or default_baseline(params or {}, base)
    source = find_source(base, run_dir, weights, metadata)
    data = required_metadata(source.metadata)
    config = config_artifact(data, source, base)
    data.setdefault("source_run", _below(source.run_dir or source.weights.parent, base))
    data["source_weights"] = _below(source.weights, base)
    if tag:
        data["tag"] = tag
    target.parent.mkdir(parents=True, exist_ok=True)
    shutil.copy2(source.weights, target)
    if config is not None:
        shutil.copy2(config, target.parent / "model_config.py")
        data["model_config_path"] = "model_config.py"
    written = target.parent / "metadata.yaml"
    written.write_text(yaml.safe_dump(data, sort_keys=False), encoding="utf-8")
    return target, written


def baseline_state(path: str) -> str:
    """"usable" if the weights have content, "missing" if they are promoted and gone, "none" else."""
    p = Path(path)
    if p.is_file() and p.stat().st_size:
        return "usable"
    return "missing" if (p.parent / "metadata.yaml").exists() else "none"


def require_baseline(path: str) -> bool:
    """Whether to compare with a baseline; an error if a promoted one is gone."""
    state = baseline_state(path)
    if state == "missing":
        raise FileNotFoundError(f"the baseline at {path} is promoted but its weights are not here")
    return state == "usable"


def upserted(registry: DataFrame, new: DataFrame, key: str = "experiment_name") -> DataFrame:
    """The registry with new rows in the place of old ones with the same key."""
    return registry.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def pointers(files: DataFrame) -> DataFrame:
    """(path, md5, size) of files with their content."""
    return files.select("path", F.md5("content").alias("md5"), F.length("content").cast("bigint").alias("size"))


def fingerprint(*parts: Any) -> str:
    """A hash of parameters and pointers that changes if and only if one of them does."""
    return hashlib.md5(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()
