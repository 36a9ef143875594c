"""Hand-made deliveries for unit tests (plain Python, local folders)."""

from __future__ import annotations

import gzip
import hashlib
import io
import os
import tarfile

HEADER = ["hitid_high", "hitid_low", "date_time", "pagename", "my col (a=b)", "curr_rate"]


def tar_gz(members: dict[str, bytes]) -> bytes:
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as tar:
        for name, data in members.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    return buf.getvalue()


def write_delivery(directory: str, feed: str, day: str, rows: list[list[str]] | list[str], *,
                   header: list[str] | None = None, lookups: dict[str, str] | None = None,
                   files: int = 1, header_text: str | None = None, archive_members: dict | None = None,
                   manifest_edit=None, newline: str = "\n", write_archive: bool = True,
                   skip_files: tuple[int, ...] = ()) -> dict:
    """Write one delivery; ``rows`` are lists of fields or raw lines."""
    os.makedirs(directory, exist_ok=True)
    header = header or HEADER
    lines = [r if isinstance(r, str) else "\t".join(r) for r in rows]
    chunks = [lines[i::files] for i in range(files)]
    data = []
    for i, chunk in enumerate(chunks):
        name = f"{i + 1:02d}-{feed}_{day}.tsv.gz"
        body = gzip.compress("".join(line + "\n" for line in chunk).encode())
        if i not in skip_files:
            with open(os.path.join(directory, name), "wb") as f:
                f.write(body)
        data.append({"name": name, "md5": hashlib.md5(body).hexdigest(), "size": len(body),
                     "records": sum(1 for line in chunk if line.strip())})
    members = archive_members if archive_members is not None else {
        "column_headers.tsv": (header_text if header_text is not None else "\t".join(header) + "\n").encode(),
        **{k: v.encode() for k, v in (lookups or {}).items()},
    }
    archive = tar_gz(members)
    arch = f"{feed}_{day}-lookup_data.tar.gz"
    if write_archive:
        with open(os.path.join(directory, arch), "wb") as f:
            f.write(archive)
    m = {"version": "1.0", "lookups": [{"name": arch, "md5": hashlib.md5(archive).hexdigest(),
                                        "size": len(archive)}],
         "data": data, "total": sum(d["records"] for d in data)}
    m["n_lookup"], m["n_data"] = len(m["lookups"]), len(m["data"])
    if manifest_edit:
        manifest_edit(m)
    text = manifest_text(m)
    if manifest_edit and "raw" in m:
        text = m["raw"]
    with open(os.path.join(directory, f"{feed}_{day}.txt"), "w", newline="") as f:
        f.write(text.replace("\n", newline))
    return m


def manifest_text(m: dict) -> str:
    out = [f"Datafeed-Manifest-Version: {m['version']}", f"Lookup-Files: {m['n_lookup']}",
           f"Data-Files: {m['n_data']}", f"Total-Records: {m['total']}", ""]
    for f in m["lookups"]:
        out += [f"Lookup-File: {f['name']}", f"MD5-Digest: {f['md5']}", f"File-Size: {f['size']}", ""]
    for f in m["data"]:
        out += [f"Data-File: {f['name']}", f"MD5-Digest: {f['md5']}", f"File-Size: {f['size']}",
                f"Record-Count: {f['records']}", ""]
    return "\n".join(out)


def row(i: int, page: str = "home", rate: str = "1.5", ts: str = "2024-01-05 10:00:00") -> list[str]:
    return ["0", str(i), ts, page, "v", rate]
