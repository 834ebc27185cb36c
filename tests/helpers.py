import datetime as dt


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def plus(text: str, n: int) -> dt.date:
    return day(text) + dt.timedelta(days=n)


def records(df, *order):
    rows = [r.asDict() for r in df.collect()]
    return sorted(rows, key=lambda r: tuple(str(r[c]) for c in order)) if order else rows
