"""Paths as Hadoop spells them, for Arrow's file systems."""


def arrow_uri(path):
    """A path as Hadoop spells it, in the spelling of Arrow's file systems."""
    scheme, _, rest = path.partition(":")
    if not rest or "/" in scheme:
        return path
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return f"{scheme}://{'/' if scheme == 'file' else ''}{rest.lstrip('/')}"
