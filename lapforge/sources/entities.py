"""Declarative registry of the landed entities: where records lie and what identifies them."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EntitySpec:
    """``scope``: what one request covers (global, season or race); ``container``: dotted path of the outer list; ``child``: list inside its elements;
    ``lifted``: fields of the outer element; ``keys``: column -> dotted path in the record."""

    name: str
    scope: str
    container: str
    keys: tuple[tuple[str, str], ...]
    child: str | None = None
    lifted: tuple[str, ...] = ()

    @property
    def grain(self) -> list[str]:
        return [c for c, _ in self.keys]


def _flat(name: str, box: str, key: str, path: str) -> EntitySpec:
    return EntitySpec(name, "global", f"MRData.{box}", ((key, path),))


def _raced(name: str, scope: str, child: str, *more: tuple[str, str], box: str = "RaceTable.Races") -> EntitySpec:
    return EntitySpec(name, scope, f"MRData.{box}", (("season", "season"), ("round", "round"), *more), child, ("season", "round"))


_DRIVER = ("driver_id", "Driver.driverId")
_STANDINGS = "StandingsTable.StandingsLists"

ENTITIES: dict[str, EntitySpec] = {
    e.name: e
    for e in (
        _flat("seasons", "SeasonTable.Seasons", "season", "season"),
        _flat("circuits", "CircuitTable.Circuits", "circuit_id", "circuitId"),
        _flat("drivers", "DriverTable.Drivers", "driver_id", "driverId"),
        _flat("constructors", "ConstructorTable.Constructors", "constructor_id", "constructorId"),
        _flat("status", "StatusTable.Status", "status_id", "statusId"),
        EntitySpec("races", "global", "MRData.RaceTable.Races", (("season", "season"), ("round", "round"))),
        _raced("results", "season", "Results", _DRIVER),
        _raced("qualifying", "season", "QualifyingResults", _DRIVER),
        _raced("sprint", "season", "SprintResults", _DRIVER),
        _raced("pitstops", "race", "PitStops", ("driver_id", "driverId"), ("stop", "stop")),
        _raced("driver_standings", "race", "DriverStandings", _DRIVER, box=_STANDINGS),
        _raced("constructor_standings", "race", "ConstructorStandings", ("constructor_id", "Constructor.constructorId"), box=_STANDINGS),
    )
}
