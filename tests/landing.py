"""Write small landed files."""

import csv
import json


def sheet(path, columns, lines):
    """A sheet range: header line, then numbered rows (dicts; absent cells are empty)."""
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(["row_no", *columns])
        for i, line in enumerate(lines, 1):
            out.writerow([i, *['""' if line.get(c) == "" else line.get(c, "") for c in columns]])
    return str(path)


def grid(path, columns, lines, skip_rows=0, cells=None):
    """A whole workbook sheet: preamble, header, rows; no header line of its own."""
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        for r in range(1, skip_rows + 1):
            row = ["note", "x"]
            for (at, c), value in (cells or {}).items():
                if at == r:
                    row[c] = value
            out.writerow([r, *row])
        out.writerow([skip_rows + 1, *columns])
        for i, line in enumerate(lines, skip_rows + 2):
            out.writerow([i, *[line.get(c, "") for c in columns]])
    return str(path)


def jsonl(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in records), encoding="utf-8")
    return str(path)
