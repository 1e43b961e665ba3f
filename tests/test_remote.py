"""Remote workbooks against a service in memory."""

import json
import re
from urllib.parse import unquote

import pytest

from gridlark import dbapi
from gridlark.errors import Error, InterfaceError, NotSupportedError, OperationalError
from gridlark.sources import remote
from gridlark.sources.xlsx import _column

WHERE = "msgraph://drives/d 1/items/i1"


class Service:
    """The part of the interface that the store uses, over matrices."""

    def __init__(self, **sheets):
        self.sheets = {n: [list(r) for r in rows] for n, rows in sheets.items()}
        self.calls, self.answers, self.tag, self.session = [], [], 1, 0

    def __call__(self, method, address, sent, body):
        path = unquote(address.removeprefix(remote.SERVICE))
        self.calls.append((method, path.removeprefix("/drives/d 1/items/i1/workbook")))
        assert sent["Authorization"] == "Bearer t0ken"
        if self.answers:
            answer = self.answers.pop(0)
            if isinstance(answer, Exception):
                raise answer
            if answer is not None:
                return answer
        content = json.loads(body) if body else {}
        if path.endswith("createSession"):
            self.session += 1
            return self.out({"id": f"s{self.session}"})
        if path.endswith("closeSession"):
            return 204, {}, b""
        if sent.get("workbook-session-id") != f"s{self.session}":
            return 404, {}, b'{"error": {"code": "invalidSessionId"}}'
        if method != "GET":
            if sent.get("If-Match", str(self.tag)) != str(self.tag):
                return 412, {}, b"precondition failed"
            self.tag += 1
        return self.out(self.do(method, path, content))

    def out(self, content):
        return 200, {"ETag": str(self.tag)}, json.dumps(content).encode()

    def do(self, method, path, content):
        if path.endswith("/workbook"):
            return {}
        if path.endswith("worksheets?$select=id,name"):
            return {"value": [{"id": f"{{{n}}}", "name": n} for n in self.sheets]}
        if path.endswith("/worksheets/add"):
            self.sheets[content["name"]] = []
            return {"id": f"{{{content['name']}}}"}
        name = re.search(r"/worksheets/\{(.*?)\}", path)[1]
        if method == "DELETE":
            del self.sheets[name]
            return {}
        rows = self.sheets[name]
        if "usedRange" in path:
            return {"values": rows or [[""]]}
        a, r, b, t = re.search(r"address='([A-Z]+)(\d+):([A-Z]+)(\d+)'", path).groups()
        left, top, right, bottom = _column(a), int(r) - 1, _column(b), int(t) - 1
        if path.endswith("/delete"):
            del rows[top : bottom + 1]
        for i in range(top, bottom + 1) if not path.endswith("/delete") else ():
            rows.extend([] for _ in range(i + 1 - len(rows)))
            rows[i].extend([""] * (right + 1 - len(rows[i])))
            rows[i][left : right + 1] = [""] * (right + 1 - left) if path.endswith("/clear") else ["" if x is None else x for x in content["values"][i - top]]
        while rows and not any(x != "" for x in rows[-1]):
            rows.pop()
        return {}


@pytest.fixture
def service():
    return Service(t=[["id", "name"], *[[i, f"n{i}"] for i in range(1, 9)]], other=[["k"], ["x"]], empty=[])


def connect(spark, service, **options):
    return dbapi.connect(WHERE, spark=spark, **{"credential": "t0ken", "transport": service, "backoff_factor": 0, "readonly": False, **options})


def writes(service):
    return [c for c in service.calls if c[0] != "GET" and "Session" not in c[1]]


def test_scan(spark, service):
    with connect(spark, service, readonly=True) as c:
        assert c.execute("SELECT name FROM t WHERE id > 6 ORDER BY id").fetchall() == [("n7",), ("n8",)]
        with pytest.raises(NotSupportedError):
            c.execute("DELETE FROM t")
    assert not writes(service) and service.calls[-1] == ("POST", "/closeSession")


def test_targeted_writes(spark, service):
    with connect(spark, service) as c:
        c.execute("UPDATE t SET name = 'new' WHERE id IN (2, 3, 6)")
        assert writes(service) == [("PATCH", "/worksheets/{t}/range(address='A3:B4')"), ("PATCH", "/worksheets/{t}/range(address='A7:B7')")]
        service.calls.clear()
        c.execute("DELETE FROM t WHERE id IN (1, 4, 5)")
        assert writes(service) == [("POST", "/worksheets/{t}/range(address='A5:B6')/delete"), ("POST", "/worksheets/{t}/range(address='A2:B2')/delete")]
        service.calls.clear()
        c.execute("INSERT INTO t VALUES (9, 'nine'), (10, NULL)")
        assert writes(service) == [("PATCH", "/worksheets/{t}/range(address='A7:B8')")]
        assert service.sheets["t"] == [["id", "name"], [2, "new"], [3, "new"], [6, "new"], [7, "n7"], [8, "n8"], [9, "nine"], [10, ""]]
        service.calls.clear()
        c.execute("UPDATE t SET name = 'all'")
        assert writes(service) == [("PATCH", "/worksheets/{t}/range(address='A1:B8')")]
        c.execute("ALTER TABLE t DROP COLUMN name")
        c.execute("CREATE TABLE made (a INTEGER, d DATE)")
        c.execute("INSERT INTO made VALUES (1, '2024-02-29')")
        c.execute("DROP TABLE other")
    assert [r[0] for r in service.sheets["t"]] == ["id", 2, 3, 6, 7, 8, 9, 10] and {x for r in service.sheets["t"] for x in r[1:]} == {""}
    assert service.sheets["made"] == [["a", "d"], [1, "2024-02-29"]] and "other" not in service.sheets


def test_plans_make_new_of_old():
    import itertools

    for old, new in itertools.product(itertools.product("abc", repeat=3), [*itertools.product("abc", repeat=2), *itertools.product("abcd", repeat=3), (), tuple("abcab")]):
        for width in (1, 2, 3):
            service = Service(t=[["h", "i"], *[[x, x] for x in old]])
            want = [["h", "i", "j"][:width], *[[x] * width for x in new]]
            store = remote.RemoteStore(WHERE, credential="t0ken", transport=service, readonly=False)
            store._list()
            store.seen["t"] = [list(r) for r in service.sheets["t"]]
            for step in remote.plan(store.seen["t"], want):
                store._apply("t", step)
            assert [r[:width] for r in service.sheets["t"]] == want and {x for r in service.sheets["t"] for x in r[width:]} <= {""}


def test_conflicts(spark, service):
    with connect(spark, service) as c:
        service.tag += 1
        with pytest.raises(OperationalError, match="Concurrent"):
            c.execute("UPDATE t SET name = 'x' WHERE id = 1")
        assert c.execute("SELECT name FROM t WHERE id = 1").fetchall() == [("n1",)]
    with connect(spark, service, conflict_strategy="force") as c:
        service.tag += 1
        c.execute("UPDATE t SET name = 'x' WHERE id = 1")
    assert service.sheets["t"][1] == [1, "x"]


def test_reading_is_tried_again_and_writing_is_not(spark, service):
    with connect(spark, service) as c:
        store = c.store
        service.answers = [OSError("gone"), (503, {}, b""), (429, {"Retry-After": "0"}, b"")]
        assert store._do("GET", "")== {}
        service.answers = [(503, {}, b"")] * 4
        with pytest.raises(OperationalError):
            store._do("GET", "")
        service.answers = [(503, {}, b"busy")]
        before = len(service.calls)
        with pytest.raises(OperationalError):
            c.execute("UPDATE t SET name = 'x' WHERE id = 1")
        assert len(service.calls) == before + 1
        for status, kind in ((401, InterfaceError), (403, InterfaceError), (404, OperationalError)):
            service.answers = [(status, {}, b"no")]
            with pytest.raises(kind):
                store._do("GET", "")
        service.session += 1  # the server has ended the session
        c.execute("UPDATE t SET name = 'y' WHERE id = 1")
    assert service.sheets["t"][1] == [1, "y"]


def test_locations_and_credentials(spark, service):
    assert remote.item_of("sharepoint://sites/s/drives/d/items/i") == "/drives/d/items/i"
    assert remote.item_of("onedrive://me/drive/items/i") == "/me/drive/items/i"

    class Scoped:
        def get_token(self, scope):
            return type("T", (), {"token": "t0ken"})

    class Plain:
        def get_token(self):
            return "t0ken"

    for credential in ("t0ken", lambda: "t0ken", Plain(), Scoped()):
        assert remote.token_source(credential)() == "t0ken"
    for bad in ({"credential": None}, {"create": True}, {"data_only": False}, {"conflict_strategy": "maybe"}, {"nope": 1}):
        with pytest.raises(Error):
            connect(spark, service, **bad)
    for where in ("msgraph://drives/d", "https://host/book.xlsx", "onedrive://me/items/i"):
        with pytest.raises(Error):
            dbapi.connect(where, spark=spark, credential="t0ken", transport=service)
    with connect(spark, service) as c, pytest.raises(NotSupportedError):
        c.autocommit = False
        c.rollback()
