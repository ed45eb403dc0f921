"""File system access for the Python data sources (local paths or any
``pyarrow.fs`` URI such as ``s3://`` or ``hdfs://``)."""

from __future__ import annotations


def filesystem(path: str):
    from pyarrow import fs as pafs

    if path.startswith("file:"):
        p = path[len("file:"):]
        while p.startswith("//"):
            p = p[1:]
        return pafs.LocalFileSystem(), p
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def join(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/")] + [p.strip("/") for p in parts[1:]])


def clear_job(fs, root: str, job: str) -> None:
    """Remove one job's private temporary folder, and the common one above it
    when no other job is using it."""
    from pyarrow import fs as pafs

    top = join(root, "_temporary")
    own = join(top, job)
    if fs.get_file_info(own).type == pafs.FileType.Directory:
        fs.delete_dir(own)
    if (fs.get_file_info(top).type == pafs.FileType.Directory
            and not fs.get_file_info(pafs.FileSelector(top, allow_not_found=True))):
        fs.delete_dir(top)


def list_files(path: str, suffix_contains: str = "") -> list[str]:
    from pyarrow import fs as pafs

    fs, root = filesystem(path)
    info = fs.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [root]
    sel = pafs.FileSelector(root, recursive=False)
    return sorted(i.path for i in fs.get_file_info(sel)
                  if i.type == pafs.FileType.File and suffix_contains in i.base_name
                  and not i.base_name.startswith(("_", ".")))
