"""Dataset manifest, zone layout and landing-file dispatch (SRC8, STR2)."""

from __future__ import annotations

import logging
import posixpath
from collections.abc import Iterable
from dataclasses import dataclass

from tunelake import schemas as S

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class DatasetSpec:
    name: str            # folder name inside each zone
    match: str           # substring that identifies its landing file
    kind: str            # tracks | charts | lyrics
    refresh: bool        # re-ingested on an update run (the daily chart)
    text: bool = False   # quoted multi-line CSV


# The three datasets, their landing-file keys and refresh flags.
MANIFEST = [
    DatasetSpec("top-spotify-songs-by-country", "top-spotify-songs-by-country", "charts", refresh=True),
    DatasetSpec("spotify-tracks-dataset", "spotify-tracks-dataset", "tracks", refresh=False),
    DatasetSpec("songs-lyrics", "songs-lyrics", "lyrics", refresh=False, text=True),
]
# Auxiliary files shipped next to the datasets that are not converted.
LANDING_DENY = ("songs_details.csv", "album_details.csv")

# The forms a landing file of each kind may have (found by header name).
LANDING_SPECS = {
    "tracks": [S.TRACKS_SPEC],
    "charts": [S.CHARTS_SPEC],
    "lyrics": [S.LYRICS_TEXT_SPEC, S.LYRICS_URL_SPEC],
}


def landing_forms(kind: str) -> list[list[str]]:
    return [[c.source for c in spec] for spec in LANDING_SPECS[kind]]


def landing_spec(kind: str, columns: Iterable[str]) -> list[S.ColumnSpec]:
    """The column spec that fits a landing table."""
    have = set(columns)
    for spec in LANDING_SPECS[kind]:
        if {c.source for c in spec} <= have:
            return spec
    raise ValueError(f"no {kind} form has the columns {sorted(have)}")


@dataclass(frozen=True)
class ZoneLayout:
    """Base folders of the zones; every table is ``<zone>/<dataset>``."""
    root: str

    def _zone(self, zone: str, name: str) -> str:
        return posixpath.join(self.root, zone, name)

    def landing(self, name: str) -> str:
        return self._zone("landing", name)

    def copy(self, name: str) -> str:
        """The landing files of a dataset as Parquet."""
        return self.landing(name) + ".parquet"

    def ledger(self, name: str) -> str:
        """The entries of the files that the copy holds."""
        return self._zone("landing/ledger", name)

    def formatted(self, name: str) -> str:
        return self._zone("formatted", name)

    def trusted(self, name: str) -> str:
        return self._zone("trusted", name)

    def exploitation(self, name: str) -> str:
        return self._zone("exploitation", name)

    def analytics(self, name: str) -> str:
        # One level only: readers and writers use the same path.
        return self._zone("analytics", name)


def dispatch(paths: Iterable[str], manifest: Iterable[DatasetSpec] = MANIFEST) -> dict[str, list[str]]:
    """SRC8: route landing files to datasets by file-name substring; files
    that match nothing (or a deny-listed auxiliary file) are logged and
    skipped. Unlike a rename-on-download, several files per dataset are all
    kept."""
    routed: dict[str, list[str]] = {}
    specs = list(manifest)
    for p in paths:
        base = posixpath.basename(p.rstrip("/"))
        if base in LANDING_DENY:
            log.info("skipping auxiliary landing file %s", p)
            continue
        spec = next((s for s in specs if s.match in base), None)
        if spec is None:
            log.warning("no dataset for landing file %s; skipped", p)
            continue
        routed.setdefault(spec.name, []).append(p)
    return routed


def datasets_to_refresh(update: bool, manifest: Iterable[DatasetSpec] = MANIFEST) -> list[DatasetSpec]:
    """STR1 manifest filter: everything on a first run, only the flagged
    datasets on an update run."""
    return [s for s in manifest if s.refresh or not update]
