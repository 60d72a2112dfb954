import pytest

from linksift.llm.license_scan import COVERAGE, DENSITY, TEMPLATES, WORD, Scanner


@pytest.mark.parametrize("copies", [1, 2, 3, 100])
@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_notices_next_to_each_other(name, copies):
    """Against plain search for the notice's words."""
    notice = TEMPLATES[name]
    text = "\n".join([notice] * copies)
    first, last = next(WORD.finditer(notice)).start(), [m.end() for m in WORD.finditer(notice)][-1]
    want = [(k * (len(notice) + 1) + first, k * (len(notice) + 1) + last) for k in range(copies)]
    got = [r[1:3] for r in Scanner({name: notice}, COVERAGE, DENSITY).scan(text)]
    assert got == want
