"""Workbooks behind the public Microsoft Graph REST interface: scan, targeted writes, conflict detection.

A sheet is read as the values of its used range. A changed sheet is compared with what was read, and the fewest calls that
make the difference are planned: rows that differ are put where they stand, rows that are gone are deleted from below,
new rows are put at the end, and only where more than half of the rows differ is the sheet written anew.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any
from urllib.parse import quote, urlsplit

from gridlark.errors import Error, InterfaceError, NotSupportedError, OperationalError
from gridlark.sources.catalog import Catalog, relation_of
from gridlark.sources.xlsx import _letters, headers

# Fixed values of the interface.
SERVICE = "https://graph.microsoft.com/v1.0"
SCHEMES = ("msgraph", "sharepoint", "onedrive")
_BUSY = frozenset((429, 503, 504))

#: Share of a sheet's rows that may be put one by one; beyond it the sheet is written anew.
TARGETED = 0.5
#: The longest wait that a server may ask for, in seconds.
LONGEST_WAIT = 60.0

#: (method, address, headers, body) to (status, headers, body). It raises OSError if there is no answer.
Transport = Callable[[str, str, dict[str, str], bytes | None], tuple[int, dict[str, str], bytes]]


def over_http(timeout: float) -> Transport:
    def call(method: str, address: str, sent: dict[str, str], body: bytes | None) -> tuple[int, dict[str, str], bytes]:
        try:
            with urllib.request.urlopen(urllib.request.Request(address, body, sent, method=method), timeout=timeout) as answer:
                return answer.status, dict(answer.headers), answer.read()
        except urllib.error.HTTPError as e:
            return e.code, dict(e.headers), e.read()

    return call


def item_of(location: str) -> str:
    """The workbook's path in the service: scheme://drives/D/items/I, scheme://sites/S/drives/D/items/I or
    scheme://me/drive/items/I."""
    split = urlsplit(location)
    if split.scheme not in SCHEMES:
        raise NotSupportedError(f"Remote workbooks have addresses of {', '.join(SCHEMES)}")
    match [p for p in f"{split.netloc}{split.path}".split("/") if p]:
        case ["drives", drive, "items", item] | ["sites", _, "drives", drive, "items", item]:
            return f"/drives/{quote(drive, safe='')}/items/{quote(item, safe='')}"
        case ["me", "drive", "items", item]:
            return f"/me/drive/items/{quote(item, safe='')}"
    raise InterfaceError(f"Not the address of a remote workbook: {location}")


def token_source(credential: Any) -> Callable[[], str]:
    """From a token, a function that gives one, or an object whose get_token does, with or without a scope."""
    if isinstance(credential, str):
        return lambda: credential
    ask = getattr(credential, "get_token", None) or (credential if callable(credential) else None)
    if ask is None:
        raise InterfaceError("credential must be a token, a function that gives one, or have get_token()")

    def token() -> str:
        try:
            try:
                got = ask()
            except TypeError:
                got = ask("https://graph.microsoft.com/.default")
        except Error:
            raise
        except Exception as e:
            raise InterfaceError(f"No token: {e}") from e
        return getattr(got, "token", got)

    return token


# what to write


@dataclass(frozen=True)
class Put:
    """Values from a row on, row 1 being the header."""

    row: int
    values: list[list[Any]]


@dataclass(frozen=True)
class Delete:
    first: int
    last: int


@dataclass(frozen=True)
class Clear:
    """From a row and column, both counted from 1, to another."""

    first: tuple[int, int]
    last: tuple[int, int]


def _runs(rows: Iterable[int]) -> Iterator[tuple[int, int]]:
    first = last = None
    for r in rows:
        if last is not None and r != last + 1:
            yield first, last
            first = None
        first, last = (r if first is None else first), r
    if last is not None:
        yield first, last


def _gone(old: list[list[Any]], new: list[list[Any]]) -> list[int] | None:
    """The places of old whose rows have to go so that new is left; None if more than that has changed."""
    out, wanted = [], iter(new)
    want = next(wanted, None)
    for place, row in enumerate(old):
        if want is not None and row == want:
            want = next(wanted, None)
        else:
            out.append(place)
    return out if want is None else None


def plan(old: list[list[Any]], new: list[list[Any]]) -> list[Put | Delete | Clear]:
    """What makes new of old, both with their headers."""
    width = len(new[0])
    seen = [[*r[:width], *[None] * (width - len(r))] for r in old]
    seen = [[None if x == "" else x for x in r] for r in seen]
    if old and [x for x in old[0] if x not in (None, "")] == new[0]:
        if len(seen) <= len(new):
            changed = [i for i, (a, b) in enumerate(zip(seen, new, strict=False), 1) if a != b]
            if len(changed) <= TARGETED * max(0, len(seen) - 1):
                added = [Put(len(seen) + 1, new[len(seen) :])] if len(new) > len(seen) else []
                return [Put(a, new[a - 1 : b]) for a, b in _runs(changed)] + added
        elif (gone := _gone(seen[1:], new[1:])) is not None:
            return [Delete(a + 2, b + 2) for a, b in reversed(list(_runs(gone)))]
    across = max(map(len, old), default=0)
    out: list[Put | Delete | Clear] = [Put(1, new)]
    if len(old) > len(new):
        out.append(Clear((len(new) + 1, 1), (len(old), max(across, width))))
    if across > width:
        out.append(Clear((1, width + 1), (len(new), across)))
    return out


def _cell(x: Any) -> Any:
    return x.isoformat(" ") if isinstance(x, dt.datetime) else x.isoformat() if isinstance(x, dt.date) else x


class RemoteStore:
    """A workbook behind the service. It is for queries only unless readonly is False; each statement is written at once.

    conflict_strategy: "fail" refuses to write what has changed since it was read, "force" writes anyway.
    """

    transactions = False

    def __init__(self, location: str, *, credential: Any = None, transport: Transport | None = None, readonly: bool = True, timeout: float = 30.0,
                 max_retries: int = 3, backoff_factor: float = 0.5, conflict_strategy: str = "fail", max_rows: int | None = None, data_only: bool = True, create: bool = False, **unknown: Any):
        if unknown:
            raise InterfaceError(f"Unknown options: {', '.join(sorted(unknown))}")
        if create or not data_only:
            raise NotSupportedError("Remote workbooks are neither created nor read for their formulas")
        if conflict_strategy not in ("fail", "force"):
            raise InterfaceError("conflict_strategy must be fail or force")
        self.book = f"{item_of(location)}/workbook"
        self.token, self.call = token_source(credential), transport or over_http(timeout)
        self.readonly, self.careful, self.max_rows = readonly, conflict_strategy == "fail", max_rows
        self.retries, self.backoff = max(0, max_retries), max(0.0, backoff_factor)
        self.session: str | None = None
        self.tag: str | None = None
        self.sheets: dict[str, str] = {}
        self.seen: dict[str, list[list[Any]]] = {}
        self.saved: dict[str, Any] = {}

    # calls

    def _once(self, method: str, path: str, body: Any = None) -> Any:
        """The answer's JSON. Only reading is tried again; writing is not, for it may have happened."""
        data = None if body is None else json.dumps(body).encode()
        tries = self.retries if method == "GET" else 0
        for attempt in range(tries + 1):
            sent = {"Authorization": f"Bearer {self.token()}", "Content-Type": "application/json"}
            if self.session:
                sent["workbook-session-id"] = self.session
            if method != "GET" and self.careful and self.tag:
                sent["If-Match"] = self.tag
            wait = self.backoff * 2**attempt
            try:
                status, got, answer = self.call(method, SERVICE + path, sent, data)
            except OSError as e:
                if attempt == tries:
                    raise OperationalError(f"The remote workbook can't be reached: {e}") from e
            else:
                if status not in _BUSY or attempt == tries:
                    return self._answer(method, status, {k.lower(): v for k, v in got.items()}, answer)
                asked = {k.lower(): v for k, v in got.items()}.get("retry-after", "")
                wait = min(float(asked), LONGEST_WAIT) if asked.replace(".", "", 1).isdigit() else wait
            time.sleep(wait)
        raise AssertionError

    def _answer(self, method: str, status: int, got: dict[str, str], answer: bytes) -> Any:
        text = answer.decode("utf-8", "replace")
        if status in (401, 403):
            raise InterfaceError(f"The remote workbook refuses access ({status}): {text}")
        if status == 412:
            raise OperationalError("Concurrent modification: the workbook has been changed by another session")
        if status >= 400:
            raise _Failed(status, f"The remote workbook answers {status}{'' if method == 'GET' else f' to {method}'}: {text}")
        try:
            content = json.loads(text) if text.strip() else {}
        except ValueError:
            content = {}
        self.tag = got.get("etag") or (content.get("@odata.etag") if isinstance(content, dict) else None) or self.tag
        return content

    def _do(self, method: str, path: str, body: Any = None) -> Any:
        if self.session is None:
            self.session = self._once("POST", f"{self.book}/createSession", {"persistChanges": not self.readonly})["id"]
            if self.careful:
                self._once("GET", self.book)
        try:
            return self._once(method, self.book + path, body)
        except _Failed as e:
            if not e.of_session:
                raise
        # a session that has run out is opened anew, once
        self.session = None
        self.session = self._once("POST", f"{self.book}/createSession", {"persistChanges": not self.readonly})["id"]
        return self._once(method, self.book + path, body)

    def _sheet(self, name: str) -> str:
        return f"/worksheets/{quote(self.sheets[name], safe='')}"

    # the store

    def load(self, catalog: Catalog) -> None:
        self._list()
        for name in self.sheets:
            values = self._do("GET", f"{self._sheet(name)}/usedRange(valuesOnly=true)?$select=values").get("values") or []
            if len(values) == 1 and all(x in (None, "") for x in values[0]):
                values = []
            if self.max_rows is not None and len(values) - 1 > self.max_rows:
                raise OperationalError(f"Sheet {name!r} has {len(values) - 1} rows, more than max_rows={self.max_rows}")
            self.seen[name] = values
            names = headers([x if x != "" else None for x in values[0]], f"sheet {name!r}") if values else []
            catalog.tables[name] = relation_of(catalog.spark, names, [[None if x == "" else x for x in r] for r in values[1:]])
        self.saved = catalog.snapshot()

    def _list(self) -> None:
        self.sheets = {s["name"]: s["id"] for s in self._do("GET", "/worksheets?$select=id,name")["value"]}

    def before_change(self) -> None:
        if self.readonly:
            raise NotSupportedError("This remote workbook was opened for queries only")

    def save(self, catalog: Catalog) -> None:
        self.before_change()
        for name in [n for n in self.sheets if n not in catalog.tables]:
            self._do("DELETE", self._sheet(name))
            del self.sheets[name]
            self.seen.pop(name, None)
        for name, relation in catalog.tables.items():
            if relation is self.saved.get(name):
                continue
            new = [list(relation.columns), *[[_cell(x) for x in r] for r in catalog.rows(name)]]
            if name not in self.sheets:
                self.sheets[name] = self._do("POST", "/worksheets/add", {"name": name})["id"]
                self.seen[name] = []
            for step in plan(self.seen[name], new):
                self._apply(name, step)
            self.seen[name] = new
        self.saved = catalog.snapshot()

    def _apply(self, name: str, step: Put | Delete | Clear) -> None:
        def range_of(first: tuple[int, int], last: tuple[int, int]) -> str:
            a, b = (f"{_letters(column - 1)}{row}" for row, column in (first, last))
            return f"{self._sheet(name)}/range(address='{a}:{b}')"

        width = max(1, len(self.seen[name][0]) if self.seen[name] else 1)
        match step:
            case Put(row, values):
                self._do("PATCH", range_of((row, 1), (row + len(values) - 1, len(values[0]))), {"values": values})
            case Delete(first, last):
                self._do("POST", f"{range_of((first, 1), (last, width))}/delete", {"shift": "Up"})
            case Clear(first, last):
                self._do("POST", f"{range_of(first, last)}/clear", {"applyTo": "Contents"})

    def close(self) -> None:
        if self.session is not None:
            try:
                self._once("POST", f"{self.book}/closeSession", {})
            except Error:  # it ends by itself
                pass
            self.session = None


class _Failed(OperationalError):
    def __init__(self, status: int, message: str):
        super().__init__(message)
        folded = message.lower()
        self.of_session = "invalidsession" in folded or status == 404 and "session" in folded
