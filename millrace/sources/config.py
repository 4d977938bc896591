"""Configurations on the driver: YAML and JSON files, searches and patches in them, index file names."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

try:
    import yaml as _yaml
except ImportError:  # only the two functions for YAML need it
    _yaml = None


def read_yaml(path: str) -> Any:
    if not _yaml:
        raise RuntimeError("reading YAML needs the yaml library")
    with open(path, encoding="utf-8") as f:
        return _yaml.safe_load(f)


def write_yaml(value: Any, path: str) -> None:
    if not _yaml:
        raise RuntimeError("writing YAML needs the yaml library")
    with open(path, "w", encoding="utf-8") as f:
        _yaml.safe_dump(value, f, allow_unicode=True)


def write_report(value: Any, path: str) -> None:
    """JSON indented by two."""
    with open(path, "w", encoding="utf-8") as f:
        f.write(json.dumps(value, indent=2))


def patched(config: dict, put: dict[str, Any], drop: tuple[str, ...] = ()) -> dict:
    """A copy with dotted paths set and top-level keys taken out."""
    out = json.loads(json.dumps({k: v for k, v in config.items() if k not in drop}))
    for path, value in put.items():
        at, *rest = path.split(".")
        here = out
        while rest:
            here = here.setdefault(at, {})
            at, *rest = rest
        here[at] = value
    return out


def training_config(base: dict, iterations: int, index_file: str, save_root: str, share: float = 0.03) -> dict:
    """A base configuration with the schedule of a number of iterations, its index and a folder named by the experiment."""
    warm = int(iterations * share)
    parts = index_file.split("/")
    name = (parts[-2] if len(parts) > 1 else "") + parts[-1].split("_")[0]
    put = {"optimizer.warmup_iters": warm, "optimizer.lr_decay_iters": iterations - warm, "data.train.index_file": index_file, "checkpoint.save_dir": f"{save_root.rstrip('/')}/{name}-sft"}
    return patched(base, put)


def values_of(config: Any, keys: tuple[str, ...] = ("save_dir", "save_path")) -> list[Any]:
    """The values of some keys in nested mappings, in order; lists are not searched."""
    found = []
    for k, v in config.items() if isinstance(config, dict) else ():
        if k in keys:
            found.append(v)
        elif isinstance(v, dict):
            found += values_of(v, keys)
    return found


def index_names(files: DataFrame, known: tuple[str, ...], name: str = "name", order: str = "pos") -> DataFrame:
    """Names without what surrounds a known dataset's name in the first file, in order, that has one; no rows if none has.

    A name that holds it twice is split at the first; an empty ending takes nothing away.
    """
    hit = F.coalesce(*[F.when(F.contains(name, F.lit(k)), F.lit(k)) for k in known])
    first = files.withColumn("k", hit).where("k is not null").agg(F.min_by(F.struct(F.col(name).alias("n"), F.col("k").alias("k")), order).alias("f"))
    at = F.expr("locate(f.k, f.n)")
    ends = first.where("f is not null").select((at - 1).alias("before"), F.expr("length(f.n) - length(f.k) - (locate(f.k, f.n) - 1)").alias("after"))
    inner = F.expr(f"substring(`{name}`, before + 1, greatest(length(`{name}`) - before - after, 0))")
    return files.join(F.broadcast(ends), F.lit(True)).select(order, inner.alias("dataset"))
