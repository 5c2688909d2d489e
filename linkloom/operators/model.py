"""The model document: prior, comparisons and their parameters, kept as JSON."""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from linkloom.operators.comparisons import Comparison, default

#: m and u of the published fit, by comparison and level (fixed values).
PUBLISHED = {
    "name": {"agree_bits20": (0.2298511181888518, 4.3027348369412003e-07), "agree_bits12": (0.34510777971777246, 1.2961196511482844e-05), "agree": (0.1052257115817167, 2.402521534513341e-05), "strong_bits20": (0.01008860833758821, 6.970502359239216e-07), "strong_bits12": (0.08883440369092757, 3.727275931472872e-05), "strong": (0.06604805342264464, 0.001572894770435827), "weak_bits12": (0.0069107363892032415, 3.3306456034874146e-05), "weak": (0.14468175595883961, 0.02785940811186163), "disagree": (0.0032518327124558977, 0.9704590041667768)},
    "age": {"0": (0.8273838502570364, 0.0190970637739184), "1-2": (0.09124167763983447, 0.06766029827201189), "3-5": (0.022905541488168996, 0.09113164197900632), ">5": (0.05846893061496019, 0.8221109959750634)},
    "sex": {"agree": (0.9929809893968541, 0.49885644530268625), "disagree": (0.0070190106031459264, 0.5011435546973139)},
    "geo": {"adm4": (0.6241125260057905, 0.0032455867031208545), "adm3": (0.19195699539101196, 0.00879177325682811), "adm2": (0.07712798849363198, 0.11278557473147449), "adm1": (0.06738825388722054, 0.6091389197689374), "different": (0.039414236222345043, 0.2660381455396391)},
    "job": {"agree": (0.8852217419628462, 0.19882649745327305), "disagree": (0.11477825803715389, 0.8011735025467269)},
    "phone": {"agree": (0.7667281184873864, 1.532209323940454e-05), "near": (0.15594617468003102, 7.396029612388776e-06), "disagree": (0.07732570683258251, 0.9999772818771483)},
}
PUBLISHED_PRIOR = 1.0996315999870703e-05


@dataclass
class LinkModel:
    prior: float
    m: dict[str, list[float | None]]
    u: dict[str, list[float | None]]
    comparisons: list[Comparison] = field(default_factory=default)

    @classmethod
    def published(cls, prior: float = PUBLISHED_PRIOR) -> LinkModel:
        cs = default()
        return cls(prior, {c.name: [PUBLISHED[c.name][x][0] for x in c.labels()] for c in cs}, {c.name: [PUBLISHED[c.name][x][1] for x in c.labels()] for c in cs}, cs)

    @property
    def prior_bits(self) -> float:
        return prior_bits(self.prior)

    def rows(self) -> list[tuple]:
        """variable, level, m, u, weight, tf_adjusted; null levels have none."""
        return [(c.name, x.label, m, u, math.log2(m / u) if m and u else None, x.tf is not None) for c in self.comparisons for x, m, u in zip(c.levels, self.m[c.name], self.u[c.name], strict=True)]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), "variable string, level string, m double, u double, weight double, tf_adjusted boolean")

    def save(self, path: str) -> None:
        doc = {"prior": self.prior, "comparisons": [{"name": c.name, "levels": [asdict(x) | {"when": None, "m": m, "u": u} for x, m, u in zip(c.levels, self.m[c.name], self.u[c.name], strict=True)]} for c in self.comparisons]}
        with open(path, "w") as f:
            json.dump(doc, f, indent=1)

    @classmethod
    def load(cls, path: str, comparisons: list[Comparison] | None = None) -> LinkModel:
        with open(path) as f:
            doc = json.load(f)
        cs = comparisons or default()
        by = {c["name"]: c["levels"] for c in doc["comparisons"]}
        for c in cs:
            if [x["label"] for x in by[c.name]] != c.labels():
                raise ValueError(f"levels of {c.name} differ from the saved ones")
        return cls(doc["prior"], *({c.name: [x[k] for x in by[c.name]] for c in cs} for k in "mu"), cs)


def prior_bits(prior: float) -> float:
    return math.log2(prior / (1 - prior))


def odds(p: float) -> float:
    return p / (1 - p)


def prob(o: float) -> float:
    return o / (1 + o)


def signature(c: Comparison, **sample: object) -> str:
    """What a comparison's u depends on: its levels, their adjusting columns, and the sample of pairs."""
    levels = [(x.label, str(x.when()) if x.when else "else", x.tf) for x in c.levels]
    return hashlib.sha1(json.dumps({"missing": str(c.missing()), "levels": levels} | sample, sort_keys=True).encode()).hexdigest()
