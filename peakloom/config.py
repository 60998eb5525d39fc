"""Settings of a quantification, checked once and then passed on."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from peakloom.functions.expr import METHODS, cutoff_spec


@dataclass(frozen=True)
class QuantConfig:
    charge_low: int = 1  # least and greatest charge of a feature
    charge_high: int = 8
    ppm_tolerance: float = 5.0  # of scans, and of links across runs
    hull_ppm: float = 5.0  # half width of a hull
    min_scans: int = 7  # MS1 scans of a feature
    min_intensity: float = 1.0  # of a peak
    rt_enlarge_factor: float = 0.5  # of a feature's time span, on either side
    graph_search: bool = False  # proteins by description and not by accession
    intensity_method: str = "top3_sum"
    cutoff: str = "t0"  # t and an intensity, or q and a quantile
    link_rt_window: float = 300.0  # seconds between linked features

    def __post_init__(self) -> None:
        if self.intensity_method not in METHODS:
            raise ValueError(f"unknown method: {self.intensity_method}")
        if not 1 <= self.charge_low <= self.charge_high:
            raise ValueError("charges run from 1 and upwards")
        for name in ("ppm_tolerance", "hull_ppm", "link_rt_window"):
            if not getattr(self, name) > 0:
                raise ValueError(f"{name} must be above 0")
        if self.rt_enlarge_factor < 0:
            raise ValueError("rt_enlarge_factor must not be below 0")
        cutoff_spec(self.cutoff)

    @property
    def protein_column(self) -> str:
        return "fasta_desc" if self.graph_search else "fasta_acc"

    @classmethod
    def of(cls, settings: Mapping[str, str]) -> "QuantConfig":
        """From texts, as command lines and parameter files give them; unknown names raise."""
        kinds = {f.name: type(f.default) for f in fields(cls)}
        if unknown := set(settings) - set(kinds):
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        read = lambda kind, text: text.strip().lower() in ("true", "1", "yes") if kind is bool else kind(text)
        return cls(**{name: read(kinds[name], text) for name, text in settings.items()})
