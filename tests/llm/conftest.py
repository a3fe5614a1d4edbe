import pytest

from landfall.llm.common import prepare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def session(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def docs(session):
    """Build a frame of documents, with columns whose names operators use too."""

    def build(rows):
        """Rows of (doc_id, text) or (doc_id, text, source)."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else "s", "x", 1, "y") for r in rows]
        schema = "doc_id long, text string, source string, host string, n long, key string"
        return session.createDataFrame(full, schema)

    return build


def components_of(links, nodes):
    """Smallest node that links reach, by brute force."""
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(root[a], root[b])
            if root[a] != least or root[b] != least:
                root[a] = root[b] = least
                changed = True
    return root
