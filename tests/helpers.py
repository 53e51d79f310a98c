"""Helpers of the tests; they run on one machine."""


def local_path(path: str) -> str:
    """A ``file:`` address as a path that open() takes."""
    return "/" + path[len("file:"):].lstrip("/") if path.startswith("file:") else path
