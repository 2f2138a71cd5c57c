"""Versioned artefacts of a run: models, mappings and feature contracts (#9, #22, #115, #123).

Every (target, brand, cutoff month, train end) has versions of its own::

    <root>/target=…/brand=…/cutoff_month=…/train_end=…/
        v=000001/models/<name>/   v=000001/mappings/<name>/      (the artefacts)
        manifests/000001.json                                    (what the version holds)

A version is written under a number that only its writer holds and becomes visible with its
manifest, which is renamed into place when all artefacts are there.  A run that fails
leaves no manifest, so readers keep the version before; two runs never write the same
folder, and one brand's models never replace another's.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.contract import FeatureContract
from tidemark.sources import files


@dataclass(frozen=True)
class Scope:
    """What a run was made for; its folder layout is the reference's."""

    target: str
    brand: str
    cutoff_month: str
    train_end: str

    def folder(self, root: str) -> str:
        parts = [f"{k}={_folder_name(v)}" for k, v in vars(self).items()]
        return "/".join([root.rstrip("/"), *parts])


def _folder_name(value: str) -> str:
    """A value as a folder name: everything but letters, digits, ``.``, ``_``, ``-`` as %XX."""
    return "".join(c if c.isascii() and (c.isalnum() or c in "._-") else
                   "".join(f"%{b:02X}" for b in c.encode()) for c in str(value))


class Draft:
    """A version being written; nothing is visible before :meth:`commit`."""

    def __init__(self, spark: SparkSession, scope: Scope, root: str):
        self.spark, self.scope, self.home = spark, scope, scope.folder(root)
        self.content = {"scope": vars(scope), "models": {}, "mappings": {}, "notes": {}}
        number = len([n for n in files.names_in(spark, f"{self.home}/manifests")
                      if n.endswith(".claim")]) + 1
        while not files.claim(spark, f"{self.home}/manifests/{number:06d}.claim"):
            number += 1
        self.version, self.folder = number, f"{self.home}/v={number:06d}"

    def model(self, name: str, model: PipelineModel, contract: FeatureContract) -> None:
        model.write().overwrite().save(f"{self.folder}/models/{name}")
        self.content["models"][name] = contract.to_dict()

    def mapping(self, name: str, table: DataFrame, label: str, code: str) -> None:
        """A (label, code) table, one row per label."""
        table.select(label, code).coalesce(1).write.mode("overwrite").parquet(
            f"{self.folder}/mappings/{name}")
        self.content["mappings"][name] = {"label": label, "code": code}

    def note(self, name: str, value) -> None:
        self.content["notes"][name] = value

    def commit(self) -> "Version":
        files.write_json(self.spark, f"{self.home}/manifests/{self.version:06d}.json",
                         self.content)
        return Version(self.spark, self.scope, self.home, self.version, self.content)


class Version:
    """A committed version; artefacts that its manifest doesn't name can't be read."""

    def __init__(self, spark: SparkSession, scope: Scope, home: str, version: int,
                 content: dict):
        self.spark, self.scope, self.version, self.content = spark, scope, version, content
        self.folder = f"{home}/v={version:06d}"

    def model(self, name: str) -> PipelineModel:
        self.contract(name)
        return PipelineModel.load(f"{self.folder}/models/{name}")

    def contract(self, name: str) -> FeatureContract:
        return FeatureContract.from_dict(self._known("models", name))

    def mapping(self, name: str) -> DataFrame:
        c = self._known("mappings", name)
        return self.spark.read.parquet(f"{self.folder}/mappings/{name}").select(
            c["label"], c["code"])

    def codes(self, name: str, most: int = 1000) -> dict:
        """A mapping as {label: code}; raises if it has more than ``most`` labels."""
        c = self._known("mappings", name)
        rows = self.mapping(name).limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"mapping {name} has more than {most} labels; join it instead")
        return {r[c["label"]]: r[c["code"]] for r in rows if r[c["label"]] is not None}

    def note(self, name: str):
        return self._known("notes", name)

    def _known(self, kind: str, name: str):
        if name not in self.content[kind]:
            raise KeyError(f"version {self.version} of {self.scope} has no {kind[:-1]} {name}")
        return self.content[kind][name]


def latest(spark: SparkSession, root: str, scope: Scope) -> Version | None:
    """The committed version with the highest number."""
    home = scope.folder(root)
    done = [n for n in files.names_in(spark, f"{home}/manifests") if n.endswith(".json")
            and not n.startswith(".")]
    if not done:
        return None
    return Version(spark, scope, home, int(done[-1].split(".")[0]),
                   files.read_json(spark, f"{home}/manifests/{done[-1]}"))
