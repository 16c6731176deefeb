"""A paged API for tests."""


def offset_pages(query, state):
    items = [{"id": f"{query}-{i}"} for i in range(7)]
    return {"items": items[state["offset"] : state["offset"] + state["limit"]]}


def cursor_pages(query, state):
    at = int(state["cursor"] or 0)
    return {"items": [{"id": f"{query}-{at}"}], "cursor": str(at + 1)}


def short_cursors(query, state):
    """Three pages of two items a query; the second item of a page is on those of every query."""
    at = int((state["cursor"] or "c0")[1:])
    return {"items": [{"id": f"{query}-{at}"}, {"link": f"common-{at}", "by": query}, {"title": "no key"}], "cursor": f"c{at + 1}" if at < 2 else None}


def numbered_pages(query, state):
    return {"items": [{"id": min(state["page"], 2), "by": query}] if state["page"] < 4 else []}
