"""A plain-Python model of the exchange, for comparison on small inputs."""

import csv
import datetime as dt
import io


def to_date(text):
    text = text.strip()
    try:
        return dt.date.fromisoformat(text)
    except ValueError:
        pass
    try:
        return dt.datetime.strptime(text, "%m/%d/%Y").date()
    except ValueError:
        return None


def first_fault(fields):
    """The reason class of a row of four fields, or none."""
    id_1, id_2, group, date = fields
    if to_date(date) is None:
        return "date"
    for name, value in [("id_1", id_1), ("id_2", id_2), ("vaccine_group", group)]:
        if not value.strip():
            return name
    return None


def read_import(text):
    """Records, or (line number, reason) of the first bad row."""
    records = []
    for number, row in enumerate(csv.reader(io.StringIO(text)), start=1):
        if not any(one.strip() for one in row):
            continue
        fault = "arity" if len(row) < 4 else first_fault(row[:4])
        if fault:
            return None, (number, fault)
        records.append((row[0], row[1], row[2], to_date(row[3])))
    return list(dict.fromkeys(records)), None


def render(records):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    for id_1, id_2, group, date in records:
        writer.writerow([id_1, id_2, group, date.strftime("%m/%d/%Y")])
    return out.getvalue()
