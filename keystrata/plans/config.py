"""Configuration of a feed."""

from __future__ import annotations

import ast
import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

HISTORY = "Hist_Data"
# The source whose hubs and links name the source file as record source on every load.
FILE_NAMED_SOURCE = "MSATS"


def literal(value: Any) -> Any:
    """A nested setting: JSON, or a quoted list or dictionary literal. Nothing is ever evaluated."""
    if not isinstance(value, str):
        return value
    try:
        return json.loads(value)
    except json.JSONDecodeError:
        return ast.literal_eval(value)


def parameters(rows: Sequence[Mapping[str, str]]) -> dict[str, Any]:
    """``ParameterCode`` / ``ParameterValue`` rows to one dictionary with the feed's source and table."""
    if not rows:
        raise ValueError("a feed needs at least one parameter")
    flat: dict[str, Any] = {row["ParameterCode"]: row["ParameterValue"] for row in rows}
    return flat | {"Source": rows[0]["Source"], "TableName": rows[0]["TableName"]}


@dataclass(frozen=True)
class HubSpec:
    name: str
    keys: tuple[str, ...]
    mapping: dict[str, str] = field(default_factory=dict)
    same_as: bool = False

    @property
    def hash_key(self) -> str:
        return f"{self.name}_HSH_KEY"


@dataclass(frozen=True)
class LinkSpec:
    name: str
    columns: tuple[str, ...]

    @property
    def hash_key(self) -> str:
        return f"{self.name}_HSH_KEY"


@dataclass(frozen=True)
class SameAsSpec:
    """Link between spellings: hash columns over raw source columns, and literal definition columns."""

    link: LinkSpec
    key_columns: dict[str, tuple[str, ...]]
    definitions: dict[str, Any]


@dataclass(frozen=True)
class FeedConfig:
    """One feed. Built from the flat parameter dictionary by `from_parameters`."""

    settings: dict[str, Any]
    names: tuple[str, ...] = ()
    hubs: tuple[HubSpec, ...] = ()
    links: tuple[LinkSpec, ...] = ()
    same_as: SameAsSpec | None = None
    satellites: tuple[str, ...] = ()
    transforms: dict[str, Any] = field(default_factory=dict)
    # All spellings of a same-as hub normally stay with that hub; True lets them reach links and satellites.
    spellings_everywhere: bool = False

    @classmethod
    def from_rows(cls, rows: Sequence[Mapping[str, str]]) -> FeedConfig:
        return cls.from_parameters(parameters(rows))

    @classmethod
    def from_parameters(cls, flat: Mapping[str, Any]) -> FeedConfig:
        props = {k: v for k, v in flat.items() if re.fullmatch(r"Prop_\d+", k)}
        links = "".join(v for k, v in flat.items() if k.startswith("LINK_INFO"))
        link_columns = literal(links) if links else {}

        hubs = []
        for i in range(1, int(flat.get("HubCount", 0)) + 1):
            name, info = flat[f"Hub_{i}_Name"], literal(flat[f"HUB_{i}_INFO"])
            same = flat.get("SALINK_HUB_NAME") == name
            hubs.append(HubSpec(name, tuple(info[name]), dict(info.get("key_mapping") or {}), same))

        same_as = None
        if str(flat.get("SAME_AS_LINK", "")).strip() == "Y" and str(flat.get("SA_LINK_NAME", "")).strip():
            same_as = _same_as(flat)

        named_links = [flat[f"Link_{i}_Name"] for i in range(1, int(flat.get("LinkCount", 0)) + 1)]
        return cls(
            settings=dict(flat),
            names=tuple(props[f"Prop_{i}"] for i in range(len(props))),
            hubs=tuple(hubs),
            links=tuple(LinkSpec(n, tuple(link_columns[n])) for n in named_links),
            same_as=same_as,
            satellites=tuple(flat[f"Sat_{i}_Name"] for i in range(1, int(flat.get("SatCount", 0)) + 1)),
            transforms={k: literal(v) for k, v in flat.items() if k.startswith("TRANSFORM_")},
        )

    def flag(self, name: str) -> bool:
        return str(self.settings.get(name, "")).strip() == "Y"

    def nested(self, name: str) -> Any:
        return literal(self.settings[name]) if name in self.settings else None

    @property
    def replicated(self) -> bool:
        return bool(self.names)

    @property
    def history(self) -> bool:
        return self.settings.get("load_type") == HISTORY

    @property
    def source_is_file(self) -> bool:
        return self.history or self.settings.get("Source") == FILE_NAMED_SOURCE

    @property
    def record_source(self) -> str:
        return self.settings["RecordSource"]

    @property
    def paths(self) -> list[str]:
        value = self.settings["data_object_name"]
        return [value] if isinstance(value, str) else list(value)

    @property
    def locations(self) -> dict[str, str]:
        """Base folders of single hubs, for `Lake.locations`."""
        return self.nested("DB_MNT_LOCATION") or {}

    @property
    def batches(self) -> int:
        return int(self.settings.get("NUMBER_OF_ITER", 1))


def _same_as(flat: Mapping[str, Any]) -> SameAsSpec:
    name = flat["SA_LINK_NAME"].strip()
    info = literal(flat["SALINK_INFO"])
    definitions = literal(flat["SALINK_KEY_DEF_INFO"])["salink_key_def_mapping"]
    keys, used = {}, {}
    for key, columns in info["salink_key_mapping"].items():
        # The last part of the key name pairs it with its definition column.
        mark = f"{key.split('_')[-1]}_DEF"
        found = {c: v for c, v in definitions.items() if mark in c}
        if found:
            keys[key] = tuple(columns)
            used |= found
    if not keys:
        raise ValueError(f"no key of {name} has a definition column")
    return SameAsSpec(LinkSpec(name, tuple(info[name])), keys, used)
