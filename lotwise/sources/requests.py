"""Options one run is asked for."""

from __future__ import annotations

import json
from dataclasses import dataclass

DOCUMENT_NAME = "traffic-rates.json"


@dataclass(frozen=True)
class Request:
    """``override`` is JSON object text or None; ``filename`` names the published document, a plain
    name within the output folder."""

    override: str | None = None
    filename: str = DOCUMENT_NAME

    def __post_init__(self) -> None:
        name = self.filename
        plain = isinstance(name, str) and name.strip(" .") and not set(name) & set("/\\:\0\n\r")
        if not plain or name.startswith((".", "_")):
            raise ValueError(f"a filename is a plain name, not {name!r}")


def parse_request(text: str | None) -> Request:
    """Read the two options from a JSON object; other keys are ignored.

    A null override counts as none. A filename must be a plain name; null and names with a
    separator, hidden ones included, are errors.
    """
    options = json.loads(text) if text else {}
    if not isinstance(options, dict):
        raise ValueError("a request is a JSON object")
    override = options.get("override")
    if override is not None and not isinstance(override, dict):
        raise ValueError("an override is a JSON object")
    return Request(
        override=json.dumps(override) if override else None,
        filename=options.get("filename", DOCUMENT_NAME),
    )
