"""Archives are read member by member with the library's results, whatever is wrong with them."""

from __future__ import annotations

import io
import random
import zipfile

import pytest

from metaferry.snapshots.document_queries import _stored_archive
from metaferry.sources import bundles


def packed(members, kind=zipfile.ZIP_STORED) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", kind) as archive:
        for name, data in members:
            info = zipfile.ZipInfo(name)
            info.external_attr, info.compress_type = 0o600 << 16, kind
            archive.writestr(info, data)
    return buffer.getvalue()


MEMBERS = [("a.json", b'{"uid":"x"}' * 40), ("sub/", b""), ("sub/b.json", "é".encode() * 9), ("empty", b""), ("é.json", b"1"), ("a.json", b"2")]


def by_library(content: bytes) -> list[tuple]:
    """What the library makes of an archive: data or the kind of problem."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
    except (zipfile.BadZipFile, ValueError, NotImplementedError) as problem:
        return [(None, None, f"bad archive: {problem}")]
    members = [m for m in archive.namelist() if not m.endswith("/")]
    if not members:
        return [(None, None, "empty archive")]
    found = []
    for member in members:
        try:
            found.append((member, archive.read(member), None))
        except Exception as problem:  # noqa: BLE001
            found.append((member, None, f"unreadable member: {problem}"))
    return found


@pytest.mark.filterwarnings("ignore:Duplicate name")
@pytest.mark.parametrize("kind", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2])
def test_damaged_archives_give_what_the_library_gives(kind):
    dice = random.Random(kind)
    whole = packed(MEMBERS, kind)
    cases = [whole, b"x" * 10 + whole, whole + b"tail", packed([]), b"", whole[:9]]
    for _ in range(1500):
        damaged = bytearray(whole)
        for _ in range(dice.randint(1, 3)):
            damaged[dice.randrange(len(damaged))] = dice.randrange(256)
        cases.append(bytes(damaged))
    for content in cases:
        assert [row[1:] for row in bundles._archive_rows("b", content)] == by_library(content)


@pytest.mark.filterwarnings("ignore:Duplicate name")
def test_plain_members_do_not_go_through_the_library(monkeypatch):
    monkeypatch.setattr(zipfile.ZipFile, "read", lambda *_: 1 / 0)
    for kind in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        found = list(bundles._archive_rows("b", packed(MEMBERS[:4], kind)))
        assert [row[1:] for row in found] == [(name, data, None) for name, data in MEMBERS[:4] if name != "sub/"]


def test_archives_of_the_queries_are_those_of_the_library():
    for members in ([("data_sources.json", '{"é":1}'), ("readme.txt", "é")], [("a/b.json", "")], []):
        assert _stored_archive(members) == packed([(name, text.encode()) for name, text in members])
