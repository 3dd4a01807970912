"""Immutable extraction profile."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from types import MappingProxyType

# Block types, words and header names that results depend on.
DROPPED_TYPES = ("header", "footer", "aside_text")
NOISE = ("copyright", "proprietary", "confidential", "document classification")
REGISTER_NAME = r"^[A-Z][A-Z0-9_]*(?:\([0-9.]+\)[A-Z0-9_]*)*$"
BIT_POSITION = r"^<\d+(?::\d+)?>$"
ENUM_SUFFIXES = ("_E", "_S")
ALIASES = {
    "bit_position": ("bit pos",), "field_name": ("field name",), "register": ("register",), "address": ("address", "bar"),
    "mnemonic": ("mnemonic",), "value": ("value", "enum"), "access": ("access",), "reset": ("reset value", "reset"),
    "typical": ("typical value", "typical"), "description": ("field description", "description"),
}
# End of fixed values.


@dataclass(frozen=True)
class Profile:
    """How one vendor's manuals name registers and table columns. Patterns match from the start of the text."""

    register_name: str = REGISTER_NAME
    require_underscore: bool = True
    bit_positions: tuple[str, ...] = (BIT_POSITION,)
    enum_suffixes: tuple[str, ...] = ENUM_SUFFIXES
    noise: tuple[str, ...] = NOISE
    aliases: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: MappingProxyType(ALIASES))

    @classmethod
    def from_dict(cls, spec: Mapping) -> Profile:
        """Aliases, bit patterns and noise are added to the defaults; enum suffixes replace them. An unknown alias key raises."""
        base = cls()
        aliases = dict(base.aliases)
        for key, names in spec.get("table_header_aliases", {}).items():
            if key not in aliases:
                raise ValueError(f"unknown key {key!r} in table_header_aliases; allowed: {', '.join(sorted(aliases))}")
            aliases[key] = tuple(dict.fromkeys((*aliases[key], *(str(n).lower() for n in names))))
        patterns = tuple(dict.fromkeys((*base.bit_positions, *map(str, spec.get("bit_position_patterns", ())))))
        for pattern in (spec.get("register_name_pattern") or base.register_name, *patterns):
            re.compile(pattern)
        return replace(
            base,
            register_name=spec.get("register_name_pattern") or base.register_name,
            require_underscore=bool(spec.get("register_require_underscore", True)),
            bit_positions=patterns,
            enum_suffixes=tuple(map(str, spec.get("enum_suffixes") or base.enum_suffixes)),
            noise=(*base.noise, *(str(n).lower() for n in spec.get("noise_substrings", ()))),
            aliases=MappingProxyType(aliases),
        )

    @classmethod
    def from_json(cls, text: str) -> Profile:
        return cls.from_dict(json.loads(text))


#: Wider header names, as the manuals of the test tables use them.
WIDE = Profile.from_dict(
    {
        "bit_position_patterns": [r"^\[\d+(?::\d+)?\]$", r"^\d+(?::\d+)?$"],
        "table_header_aliases": {
            "bit_position": ["bits", "bit range", "position"], "field_name": ["field", "name", "symbol"], "address": ["offset"], "mnemonic": ["symbol", "label"],
            "value": ["encoding", "code"], "access": ["type", "mode"], "reset": ["default"], "description": ["meaning", "function"],
        },
    }
)
