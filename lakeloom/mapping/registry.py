"""Which mapping serves which event type."""

from __future__ import annotations

from lakeloom.mapping.spec import Mapping
from lakeloom.mapping.specs import activity, people, things

MAPPINGS: dict[str, Mapping] = {m.name: m for m in [*people.MAPPINGS, *activity.MAPPINGS, *things.MAPPINGS]}

EVENT_TYPES: dict[str, Mapping] = {t: m for m in MAPPINGS.values() for t in m.event_types}


def register(mapping: Mapping) -> None:
    """Add a mapping of your own; its event types must be free."""
    taken = [t for t in mapping.event_types if t in EVENT_TYPES]
    if taken or mapping.name in MAPPINGS:
        raise ValueError(f"already mapped: {taken or mapping.name}")
    MAPPINGS[mapping.name] = mapping
    EVENT_TYPES.update(dict.fromkeys(mapping.event_types, mapping))
