"""Job parameters: discovered and configured catalogs, and what the user overrides."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from millrace.functions.jsonschema import prune_change_columns
from millrace.operators.envelope import Descriptor
from millrace.sources.tables import MAIN, Identifier

# Namespace of streams that have none, and names of the sync modes.
DEFAULT_NAMESPACE = "default"
INCREMENTAL = "incremental"
FULL_REFRESH = "full_refresh"


@dataclass(frozen=True)
class StreamConfig:
    """Overrides for one stream. ``partition_by`` maps columns to transforms, in order."""

    sync_mode: str | None = None
    cursor_field: list[str] | None = None
    partition_by: dict[str, str] | None = None


@dataclass(frozen=True)
class SyncConfig:
    """Overrides for a sync.

    ``streams`` is keyed by stream name or ``namespace.name``; when it is not empty, only the streams
    it names are loaded. ``wide_numbers`` makes integers and numbers 64 bit. ``check_keywords`` holds records to all
    keywords of their schema, not the types only; one that is not known is an error unless ``ignored_keywords`` names it.
    ``rejects`` is a folder to which malformed lines go with their reason, instead of ending the job.
    """

    namespace: str | None = None
    streams: dict[str, StreamConfig] = field(default_factory=dict)
    branch: str = MAIN
    wide_numbers: bool = False
    parallel_streams: int = 8
    check_keywords: bool = False
    ignored_keywords: tuple[str, ...] = ()
    rejects: str | None = None

    @property
    def keywords(self) -> tuple[str, ...] | None:
        """What ``load_records`` is told: None checks no keywords."""
        return self.ignored_keywords if self.check_keywords else None

    def identifier(self, name: str, namespace: str | None) -> Identifier:
        return Identifier(self.namespace or namespace or DEFAULT_NAMESPACE, name)

    def stream(self, name: str, namespace: str | None) -> StreamConfig | None:
        """Overrides of a stream, by either form of its name."""
        full = str(self.identifier(name, namespace))
        return self.streams.get(full) or self.streams.get(name)

    def is_selected(self, name: str, namespace: str | None) -> bool:
        full = str(self.identifier(name, namespace))
        return not self.streams or full in self.streams or name in self.streams


@dataclass(frozen=True)
class Stream:
    """One stream of a configured catalog."""

    descriptor: Descriptor
    ident: Identifier
    json_schema: dict
    mode: str
    partition_by: dict[str, str]


def configure_catalog(catalog: dict | str, config: SyncConfig | None = None) -> dict:
    """A configured catalog from a discovered one (a CATALOG message).

    A stream is incremental if it can be, unless a full refresh is asked for. Incremental streams are
    appended; full refreshes overwrite and lose their change-data columns.
    """
    config = config or SyncConfig()
    message = json.loads(catalog) if isinstance(catalog, str) else catalog
    if message.get("type") != "CATALOG":
        raise ValueError("The message holds no catalog.")
    streams = []
    for stream in message["catalog"]["streams"]:
        name, namespace = stream["name"], stream.get("namespace")
        if not config.is_selected(name, namespace):
            continue
        overrides = config.stream(name, namespace) or StreamConfig()
        can_append = INCREMENTAL in (stream.get("supported_sync_modes") or [])
        incremental = can_append and overrides.sync_mode != FULL_REFRESH
        stream = dict(stream)
        if not incremental:
            stream["json_schema"] = prune_change_columns(stream["json_schema"])
        streams.append(
            {
                "stream": stream,
                "sync_mode": INCREMENTAL if incremental else FULL_REFRESH,
                "destination_sync_mode": "append" if incremental else "overwrite",
                "cursor_field": overrides.cursor_field or stream.get("default_cursor_field"),
                "primary_key": stream.get("source_defined_primary_key"),
            }
        )
    return {"streams": streams}


def is_discovered(catalog: dict) -> bool:
    return catalog.get("type") == "CATALOG"


def known_descriptors(catalog: dict) -> list[Descriptor]:
    """All streams of a catalog, discovered or configured, selected or not."""
    if is_discovered(catalog):
        streams = catalog["catalog"]["streams"]
    else:
        streams = [configured["stream"] for configured in catalog["streams"]]
    return [Descriptor(s["name"], s.get("namespace")) for s in streams]


def selected_streams(catalog: dict, config: SyncConfig) -> list[Stream]:
    """The streams a sync loads. A mode that cannot be written is refused here, before any job."""
    configured = configure_catalog(catalog, config) if is_discovered(catalog) else catalog
    streams: list[Stream] = []
    idents: set[Identifier] = set()
    for entry in configured["streams"]:
        stream = entry["stream"]
        name, namespace = stream["name"], stream.get("namespace")
        if not config.is_selected(name, namespace):
            continue
        mode = entry["destination_sync_mode"]
        if mode not in ("append", "overwrite"):
            raise ValueError(f"Sync mode {mode} of stream {name} is invalid.")
        ident = config.identifier(name, namespace)
        if ident in idents:
            raise ValueError(f"Two streams go to the table {ident}.")
        idents.add(ident)
        overrides = config.stream(name, namespace) or StreamConfig()
        streams.append(
            Stream(
                descriptor=Descriptor(name, namespace),
                ident=ident,
                json_schema=stream["json_schema"],
                mode=mode,
                partition_by=overrides.partition_by or {},
            )
        )
    return streams
