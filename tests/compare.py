"""Rows of two engines in one comparable form."""


def norm(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        return ("f", repr(v))
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, (list, tuple)):
        return ("l", tuple(norm(x) for x in v))
    if v is None:
        return ("n",)
    return (type(v).__name__, str(v))


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)
