"""The variable registry: which columns exist, where they come from, how they are labelled."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from panelweave import fixed_values as fixed


@dataclass(frozen=True)
class Variable:
    name: str
    dataset: str
    label: str
    scale: str = "--"
    kind: str = "continuous"
    note: str = ""


@dataclass(frozen=True)
class Harmonised:
    """One question asked in several versions; ``recode`` is None to pass values through."""

    name: str
    dataset: str
    label: str
    sources: tuple[tuple[str, dict | None], ...]


@dataclass(frozen=True)
class Derived:
    name: str
    label: str
    scale: str
    sources: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class Sector:
    id: int
    label: str
    rev1: tuple[int, ...]
    rev2: tuple[int, ...]


@dataclass(frozen=True)
class Registry:
    variables: dict[str, tuple[Variable, ...]]
    panels: tuple[tuple[str, str], ...]
    harmonised: tuple[Harmonised, ...] = ()
    derived: tuple[Derived, ...] = ()
    sectors: tuple[Sector, ...] = ()
    study_years: tuple[int, ...] = ()
    survey_dir: str = "."
    key_files: dict[str, str] = field(default_factory=dict)

    # -- construction ---------------------------------------------------------------

    @classmethod
    def default(cls, **overrides) -> "Registry":
        registry = cls(
            variables={key: tuple(Variable(*row) for row in rows) for key, _, rows in fixed.VARIABLES},
            panels=tuple((key, label) for key, label, _ in fixed.VARIABLES),
            harmonised=tuple(Harmonised(*row) for row in fixed.HARMONISED),
            derived=tuple(Derived(*row) for row in fixed.DERIVED),
            sectors=tuple(Sector(*row) for row in fixed.SECTORS),
            study_years=fixed.STUDY_YEARS,
            key_files=dict(fixed.KEY_FILES),
        )
        return replace(registry, **overrides)

    @classmethod
    def from_json(cls, path: str, folder_key: str = "survey_dir") -> "Registry":
        """Load a study configuration file; ``folder_key`` names the entry of ``data`` with the folder of the files."""
        with open(path, encoding="utf-8") as handle:
            return cls.from_document(json.load(handle), folder_key, path)

    @classmethod
    def load(cls, spark, path: str, folder_key: str = "survey_dir") -> "Registry":
        """The same, from any file that Spark can read."""
        (row,) = spark.read.text(path, wholetext=True).collect()
        return cls.from_document(json.loads(row.value), folder_key, path)

    @classmethod
    def from_document(cls, doc: dict, folder_key: str = "survey_dir", path: str = "the study configuration") -> "Registry":
        if folder_key not in doc.get("data", {}):
            raise KeyError(f"{path}: section data has no entry {folder_key!r} for the folder of the survey files")

        def recode(source):
            pairs = source.get("recode")
            return None if pairs is None else {int(k): v for k, v in pairs.items()}

        return cls(
            variables={
                key: tuple(
                    Variable(v["name"], v["dataset"], v["label"], v.get("scale", "--"),
                             v.get("type", "continuous").lower(), v.get("note", ""))
                    for v in rows
                )
                for key, rows in doc["variables"].items()
            },
            panels=tuple((p["key"], p["label"]) for p in doc.get("panels", [])),
            harmonised=tuple(
                Harmonised(h["name"], h["dataset"], h["label"],
                           tuple((s["variable"], recode(s)) for s in h["sources"]))
                for h in doc.get("harmonize", [])
            ),
            derived=tuple(
                Derived(d["name"], d["label"], d.get("scale", "--"),
                        tuple((s["dataset"], s["name"]) for s in d.get("source_vars", [])))
                for d in doc.get("derived", [])
            ),
            sectors=tuple(
                Sector(s["id"], s["label"], tuple(s["nace_rev1"]), tuple(s["nace_rev2"]))
                for s in doc.get("nace_sectors", [])
            ),
            study_years=tuple(doc.get("study", {}).get("study_years", [])),
            survey_dir=doc["data"][folder_key],
            key_files=dict(doc.get("data", {}).get("key_files", {})),
        )

    # -- what is needed from where ----------------------------------------------------

    def all_variables(self) -> list[Variable]:
        return [v for rows in self.variables.values() for v in rows]

    @staticmethod
    def entity_key(dataset: str) -> str:
        return "hid" if dataset in fixed.HOUSEHOLD_DATASETS else "pid"

    def _harmonised_names(self) -> set[str]:
        return {h.name for h in self.harmonised}

    def raw_columns(self) -> dict[str, set[str]]:
        """Dataset → lower-cased raw columns to read; computed columns are not raw."""
        needed: dict[str, set[str]] = {}
        computed = self._harmonised_names()
        pairs = [(v.dataset, v.name) for v in self.all_variables()
                 if v.dataset != "derived" and v.name not in computed]
        pairs += [(h.dataset, column) for h in self.harmonised for column, _ in h.sources]
        pairs += [source for d in self.derived for source in d.sources]
        for dataset, column in pairs:
            needed.setdefault(dataset, set()).add(column.lower())
        return needed

    def stored_columns(self, dataset: str) -> set[str]:
        """Columns an extracted table must have to count as up to date."""
        computed = self._harmonised_names()
        direct = {v.name.lower() for v in self.all_variables() if v.dataset == dataset and v.name not in computed}
        derived = {column.lower() for d in self.derived for source, column in d.sources if source == dataset}
        outputs = {h.name.lower() for h in self.harmonised if h.dataset == dataset}
        return {self.entity_key(dataset), "syear"} | direct | derived | outputs

    def datasets(self) -> list[str]:
        return list(self.raw_columns())

    def csv_path(self, dataset: str) -> str:
        return f"{self.survey_dir}/{self.key_files.get(dataset, dataset + '.csv')}"

    # -- labels -------------------------------------------------------------------------

    def labels(self) -> dict[str, str]:
        """Column → label; derived and harmonised labels override those of plain variables."""
        named = [("syear", "Survey Year")]
        named += [(v.name, v.label) for v in self.all_variables()]
        named += [(d.name, d.label) for d in self.derived]
        named += [(h.name, h.label) for h in self.harmonised]
        return {name.lower(): label for name, label in named}

    def period_label(self, dash: str = "–") -> str:
        return f"{min(self.study_years)}{dash}{max(self.study_years)}"
