"""Hand-made control files: header, body and footer lines in one CSV per table and day."""

DETAILS_DDL = (
    "flag string, period timestamp, id int, first_name string, last_name string, email string, "
    "gender string, job_title string, amount double"
)
PREFERENCES_DDL = "flag string, period timestamp, id int, contact_allowed boolean"
DAYS = ["20230101", "20230102", "20230103"]

# (table, day): (body lines, row count stated in the header)
SHAPE = {
    ("customer_details_1", "20230101"): (10, 10),
    ("customer_details_1", "20230102"): (12, 12),
    ("customer_details_1", "20230103"): (12, 12),
    ("customer_details_2", "20230101"): (6, 6),
    ("customer_details_2", "20230102"): (10, 10),
    ("customer_details_2", "20230103"): (17, 10),
    ("customer_preferences", "20230101"): (16, 16),
    ("customer_preferences", "20230102"): (23, 12),
    ("customer_preferences", "20230103"): (24, 24),
}


def body_line(table: str, day: str, i: int) -> str:
    stamp = f"{day[:4]}-{day[4:6]}-{day[6:]} 13:32:34.000"
    if table == "customer_preferences":
        return f'"I",{stamp},{i},{"True" if i % 2 else "False"}'
    title = "" if i == 3 else f"Clerk, grade {i}"
    return f'"I",{stamp},{i},"Zoë","O""Neil {i}","z{i}@example.org","Female","{title}",{i * 100}.50'


def write_file(root, table: str, day: str, footer: bool = True, header: bool = True):
    body, stated = SHAPE[table, day]
    lines = [f'"H",{stated},{day}132154,batch{day[-1]}'] if header else []
    lines += [body_line(table, day, i) for i in range(1, body + 1)]
    if footer:
        lines.append(f'"F",{table},{day}133443')
    folder = root / table / day
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{table}-{day}.csv"
    path.write_bytes(("\r\n".join(lines) + "\r\n\r\n").encode("windows-1252"))
    return path


def write_all(root, table: str):
    for day in DAYS:
        write_file(root, table, day)
    return str(root) + "/{{table}}/{{path_date_format}}/{{table}}-{{filename_date_format}}*.csv"
