"""Sales CSV: formats, rejects, duplicates, headers and records across line ends."""

from datetime import date, datetime
from decimal import Decimal

import csv
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from mostrador.operators import audit, keyed
from mostrador.sources import landing, sales_csv

HEADER = "folio,fecha,producto_id,cantidad,precio_unitario,canal\n"


@pytest.fixture
def land(spark, tmp_path):
    def write(*texts, encoding="utf-8"):
        folder = tmp_path / "in"
        folder.mkdir(exist_ok=True)
        for i, text in enumerate(texts):
            (folder / f"f{i}.csv").write_bytes(text if isinstance(text, bytes) else text.encode(encoding))
        landed = landing.land_lines(spark, str(folder), "ventas", datetime.now(), str(tmp_path / "crudo"), sales_csv.COLUMNS)
        return landing.landed_lines(spark, landed), landing.landed_files(spark, landed)

    return write


def loaded(landed):
    lines = landed[0]
    classified = sales_csv.classify(sales_csv.scan(*landed))
    kept = keyed.latest_by_key(
        sales_csv.accepted(classified).drop("registro"), sales_csv.KEYS, sales_csv.POSITION
    ).orderBy("folio", "producto_id")
    rows = [(r.folio, r.fecha, r.producto_id, r.cantidad, r.precio_unitario, r.canal) for r in kept.collect()]
    rejects = sales_csv.number_records(sales_csv.rejected(classified), lines).orderBy("archivo_no", "registro")
    counts = audit.load_counters(classified, sales_csv.KEYS, flaw="falla").first().asDict()
    return rows, [(r.registro, r.motivo) for r in rejects.collect()], counts


def test_formats_are_normalised(land):
    rows, rejects, _ = loaded(land(
        HEADER
        + 'K/31,9/3/2025,+0012,1_5,"$ 2,345,678.9",\tWhatsApp\n'
        + "K/32,2025-3-9,٣,５,.5,tIENDA\n"
        + "K/33,١٥/٠٣/٢٠٢٥,12,6,1e3,Tienda\n"
    ))
    assert rejects == []
    assert rows == [
        ("K/31", date(2025, 3, 9), 12, 15, Decimal("2345678.90"), "WhatsApp"),
        ("K/32", date(2025, 3, 9), 3, 5, Decimal("0.50"), "Tienda"),
        ("K/33", date(2025, 3, 15), 12, 6, Decimal("1000.00"), "Tienda"),
    ]


@pytest.mark.parametrize("price", [
    "2.6650000000000000000001", "2.6650000000000000000000", "2.66499999999999999999", "2.67499999999999999999999",
    "2.675000000000000000", "2.67500000000000000000000001", "0.00500000000000000000001", "12.3449999999999999999999999",
])
def test_prices_round_to_the_even_cent_whatever_their_length(land, price):
    rows, _, _ = loaded(land(HEADER + f"K/1,2025-03-09,3,1,{price},tienda\n"))
    assert rows[0][4] == Decimal(price).quantize(Decimal("0.01"))


def test_rejects_carry_record_number_and_first_reason(land):
    rows, rejects, counts = loaded(land(
        HEADER
        + "K/40,2025-03-09,3,1,15,Feria\n"
        + "K/41,31/02/2025,3,1,15,tienda\n"
        + "K/42,2025-03-09,3,1,15,tienda\n"
        + " ,2025-03-09,-3,0,gratis,tienda\n"
        + "K/44,2025-03-09,3,-2,gratis,tienda\n"
        + "K/45,2025-03-09,3,1,gratis,Feria\n"
        + "K/46,2025-03-09,1.5,,15,tienda\n"
        + "K/47,2025-03-09,3,\n"
    ))
    assert [r[0] for r in rows] == ["K/42"]
    assert rejects == [
        (2, "canal desconocido: 'Feria'"),
        (3, "fecha no es una fecha válida: '31/02/2025'"),
        (5, "folio vacío"),
        (6, "cantidad debe ser mayor a 0: -2"),
        (7, "precio_unitario no es una cantidad: 'gratis'"),
        (8, "producto_id no es un número entero: '1.5'"),
        (9, "cantidad vacío"),
    ]
    assert counts == {"leidas": 8, "rechazadas": 7, "duplicadas": 0, "cargadas": 1}


def test_last_record_of_a_key_wins(land):
    rows, _, counts = loaded(land(
        HEADER + "".join(f"K/50,2025-03-0{n},{n % 2 + 8},{n},1{n}.5,tienda\n" for n in (1, 2, 3, 4, 5))
    ))
    assert [(r[1].day, r[2], r[3], r[4]) for r in rows] == [(4, 8, 4, Decimal("14.50")), (5, 9, 5, Decimal("15.50"))]
    assert counts == {"leidas": 5, "rechazadas": 0, "duplicadas": 3, "cargadas": 2}


# A field of 131,072 characters is the longest; a longer one stops the load (a quote left open, as a rule).


@pytest.mark.parametrize("extra, fits", [(0, True), (1, False)])
def test_longest_field(land, extra, fits):
    text = HEADER + "x" * (sales_csv.FIELD_LIMIT + extra) + ",2025-03-09,3,1,10,tienda\n"
    if fits:
        assert len(sales_csv.scan(*land(text)).first().folio) == sales_csv.FIELD_LIMIT
    else:
        with pytest.raises(Exception, match="131072 caracteres"):
            sales_csv.scan(*land(text)).collect()


@pytest.mark.parametrize("split", ["1m", "10k"])
def test_open_quote_stops_the_load(spark, land, split):
    rows = "".join(f"K/{i},2025-03-09,3,1,10,tienda\n" for i in range(6_000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        lines = land(HEADER + "K/a,2025-03-09,3,1,10,tienda\n" + '"K/b,2025-03-09,3,1,10,tienda\n' + rows)
        with pytest.raises(ValueError, match="f0.csv, registro 3"):
            sales_csv.scan(*lines)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_many_fields_over_lines_are_no_open_quote(land):
    block = '"' + "nota\n" * 20_000 + '",2025-03-09,3,1,10,tienda\n'
    found = sales_csv.scan(*land(HEADER + block + block.replace("nota", "otra"))).collect()
    assert [len(r.folio) for r in found] == [100_000, 100_000]


def test_missing_columns_stop_the_load(land):
    with pytest.raises(ValueError, match="fecha, canal"):
        sales_csv.scan(*land("folio,producto_id,cantidad,precio_unitario\n"))


def test_header_only_file_loads_nothing(land):
    assert loaded(land(HEADER)) == ([], [], {"leidas": 0, "rechazadas": 0, "duplicadas": 0, "cargadas": 0})


def test_column_order_extra_columns_bom_and_line_ends(land):
    rows, rejects, _ = loaded(land(
        "\ufeffcanal,folio,nota,cantidad,precio_unitario,producto_id,fecha\r\n"
        "tienda,A-1,x,2,10.5,3,2026-07-01,extra,fields\r\n"
        "\r\n"
        "   \r\n"
        "tienda,,x,2,10.5,3,2026-07-01\r\n"
    ))
    assert rows == [("A-1", date(2026, 7, 1), 3, 2, Decimal("10.50"), "Tienda")]
    assert rejects == [(3, "folio vacío"), (4, "folio vacío")]


def test_files_with_different_headers(land):
    rows, rejects, _ = loaded(land(
        HEADER + "A-1,2026-07-01,3,2,10.5,tienda\nA-2,2026-07-01,3,x,10.5,tienda\n",
        "canal,folio,cantidad,precio_unitario,producto_id,fecha\ntienda,B-1,4,7,8,2026-07-02\ntienda,B-2,4,7,8,ayer\n",
    ))
    assert [(r[0], r[2], r[3]) for r in rows] == [("A-1", 3, 2), ("B-1", 8, 4)]
    assert rejects == [(3, "cantidad no es un número entero: 'x'"), (3, "fecha no es una fecha válida: 'ayer'")]


def test_later_file_wins_over_earlier(land):
    rows, _, counts = loaded(land(
        HEADER + "A-1,2026-07-01,3,2,10.5,tienda\n", HEADER + "A-1,2026-07-01,3,9,10.5,tienda\n"
    ))
    assert rows[0][3] == 9 and counts["duplicadas"] == 1


def reference_records(text):
    """Records as a plain CSV reader sees them."""
    return [r for r in csv.reader(io.StringIO(text.replace("\r\n", "\n").replace("\r", "\n"))) if r]


QUOTED = [
    'A-1,2026-07-01,3,1,10,"tienda"\n"A\n2",2026-07-01,3,2,10,tienda\nA-3,2026-07-01,3,3,10,tienda\n',
    '"A ""x""\n\n2\r\n,3",2026-07-01,3,1,10,tienda\r\n\r\nA-2,2026-07-01,3,2,10,tienda\r\n',
    'in"side,2026-07-01,3,1,10,tienda\n"o,\n""\n"",p",2026-07-01,4,2,10,tienda\nz,2026-07-01,5,3,10,tienda\n',
    'A-1,2026-07-01,3,1,10,tienda\rA-2,2026-07-01,3,2,10,tienda\rA-3,2026-07-01,3,x,10,tienda',
    '"never closed,2026-07-01,3,1,10,tienda\nA-2,2026-07-01,3,2,10,tienda\n',
]


@pytest.mark.parametrize("body", QUOTED)
def test_fields_that_run_over_lines(land, body):
    text = HEADER + body
    lines, files = land(text)
    found = sales_csv.scan(lines, files).orderBy("registro").collect()
    records = reference_records(text)[1:]
    expected = [tuple((f if f != "" else None) for f in (r + [None] * 6)[:6]) for r in records]
    # A quote that is never closed takes the rest of the file; only its last line end is left off.
    found = [tuple(r[name] for name in sales_csv.COLUMNS) for r in found]
    assert found == [(r[0].rstrip("\n"), *r[1:]) for r in expected]
    numbered = sales_csv.number_records(sales_csv.scan(lines, files), lines).orderBy("registro").collect()
    assert [r.registro for r in numbered] == list(range(2, len(records) + 2))


def test_records_are_the_same_however_the_file_is_split(spark, land):
    body = "".join(
        f'"F-{i}\n""{i % 7}""",2026-07-01,{i % 9 + 1},{i + 1},10,tienda\n' if i % 3 == 0
        else f"F-{i},2026-07-01,{i % 9 + 1},{i + 1 if i % 11 else 'x'},10,tienda\n" + ("\n" if i % 5 == 0 else "")
        for i in range(400)
    )
    records = reference_records(HEADER + body)[1:]
    plain = body.replace('\n""', "|").replace('""', "").replace('"', "")
    plain_records = reference_records(HEADER + plain)[1:]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        lines, files = land(HEADER + body, HEADER + plain)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert lines.select("archivo_no", "bloque").distinct().count() > 20
    numbered = sales_csv.number_records(sales_csv.scan(lines, files), lines).orderBy("archivo_no", "registro").collect()
    for file_no, expected in ((1, records), (2, plain_records)):
        mine = [r for r in numbered if r.archivo_no == file_no]
        assert [r.registro for r in mine] == list(range(2, len(expected) + 2))
        assert [r.folio for r in mine] == [r[0] for r in expected]
        assert [r.cantidad for r in mine] == [r[3] for r in expected]


@pytest.mark.parametrize("split", ["1m", "40"])
def test_landed_files_come_back_byte_for_byte(spark, land, tmp_path, split):
    long = "".join(f"row {i}\n" if i % 7 else "\n" for i in range(60))
    sources = ["\ufeff" + HEADER + "A\r\nB", HEADER + "x\n\ny\n", "\ufeffa\n", "\n", "z\n\n\r\n", "one", "\ufeff" + long + "ñ", long]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        lines, files = land(*sources)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for size in (landing.PIECE, 16):
        back = {}
        for r in landing.restored_pieces(lines, files, size).collect():
            so_far = back.setdefault(r.archivo_no, b"")
            assert len(so_far) == r.desde  # sorted, and without a gap
            back[r.archivo_no] = so_far + bytes(r.contenido)
        assert [back[i].decode() for i in sorted(back)] == sources
    check = landing.line_copy_check(lines, files).orderBy("archivo_no").collect()
    assert [r.lineas for r in check] == [3, 4, 1, 1, 3, 1, 61, 60]
    for r, source in zip(check, sources):
        own = source.removeprefix("\ufeff").encode().split(b"\n")
        own = own[:-1] if own[-1] == b"" else own
        digests = [hashlib.md5(b"%d:" % n + line).hexdigest() for n, line in enumerate(own, 1)]
        sums = [sum(int(x[at : at + 15], 16) for x in digests) for at in (0, 16)]
        assert r.huella == hashlib.md5(f"{len(own)}/{sums[0]}/{sums[1]}".encode()).hexdigest()
    # Each piece is put together in its split: no task needs a file.
    assert lines.select("archivo_no", "bloque").distinct().count() > (10 if split == "40" else 7)


def test_pieces_are_dealt_by_the_sizes_of_the_files(spark, land, monkeypatch):
    """In ranges that the file list gives: the pieces are not worked out a first time to find them."""
    sources = [HEADER + f"{i}\n" * (50 * i + 1) for i in range(6)]
    lines, files = land(*sources)
    total = sum(len(s.encode()) for s in sources)
    monkeypatch.setattr(landing, "_ranges", lambda spark, size: 4 if size == total else pytest.fail("not the bytes of all files"))
    pieces = landing.restored_pieces(lines, files, 16)
    assert "rangepartitioning" not in pieces._jdf.queryExecution().toString()
    rows = pieces.select(F.spark_partition_id().alias("p"), "archivo_no", "desde", "contenido").collect()
    assert [(r.archivo_no, r.desde) for r in rows] == sorted((r.archivo_no, r.desde) for r in rows)
    assert {r.p for r in rows} == {0, 1, 2, 3}
    held = [sum(len(r.contenido) for r in rows if r.p == p) for p in range(4)]
    assert sum(held) == total and max(held) - min(held) < 64
    assert b"".join(bytes(r.contenido) for r in rows).decode() == "".join(sources)


@pytest.mark.parametrize("total, asked, ranges", [(0, 8, 1), (1, 8, 1), (3 << 20, 8, 3), (1 << 30, 8, 8), ((1 << 40) + 1, 8, 8193)])
def test_number_of_ranges_follows_the_bytes(spark, total, asked, ranges):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(asked))
    try:
        assert landing._ranges(spark, total) == ranges
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_copies_are_compared_with_their_files(spark, land, tmp_path):
    lines, _ = land(HEADER + "one\ntwo\n", HEADER + "one\ntwo\n")
    folder = str(tmp_path / "in")
    assert landing.copies_that_differ(spark, folder, lines).collect() == []
    (tmp_path / "in" / "f1.csv").write_text(HEADER + "two\none\n")
    assert [r.archivo[-6:] for r in landing.copies_that_differ(spark, folder, lines).collect()] == ["f1.csv"]


def test_plans_do_not_grow_with_the_spellings_of_headers(spark, land):
    """Each file has its columns in another order, some with further ones, quoted or repeated names."""
    texts, expected = [], set()
    for i in range(12):
        names = list(sales_csv.COLUMNS[i % 6 :] + sales_csv.COLUMNS[: i % 6])
        values = dict(zip(sales_csv.COLUMNS, (f"F-{i}", "2025-03-09", str(i + 1), "2", "10.5", "tienda")))
        row = [values[n] for n in names]
        if i % 3 == 1:
            names, row = [*names, "nota", "folio"], [*row, 'x, ""y""', f"L-{i}"]
            values["folio"] = f"L-{i}"
        if i % 4 == 2:
            names, row = ["a, b", *names], ["z", *row]
        quote = lambda x: f'"{x}"' if "," in x or i % 2 else x
        texts.append(",".join(map(quote, names)) + "\n" + ",".join(map(quote, row)) + "\n")
        expected.add(tuple(values[n] for n in sales_csv.COLUMNS))
    scanned = sales_csv.scan(*land(*texts))
    assert {tuple(r[n] for n in sales_csv.COLUMNS) for r in scanned.collect()} == expected
    few = sales_csv.scan(*land(*texts[:2]))
    size = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("from_csv")
    assert size(scanned) == size(few)


def test_a_copy_that_lacks_bytes_is_refused(spark, land, tmp_path):
    land(HEADER + "one\ntwo\n")
    folder = str(next((tmp_path / "crudo" / "ventas").iterdir()))
    lines = landing.landed_lines(spark, folder).where("contenido <> 'two'")
    with pytest.raises(Exception, match="copia incompleta"):
        landing._with_ends(landing.landed_files(spark, folder).select("archivo_no", "archivo", "bytes"), lines).collect()


def test_missing_input_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        landing.land_lines(spark, str(tmp_path / "none.csv"), "ventas", datetime.now(), str(tmp_path))


def test_lines_are_placed_in_one_pass(land, monkeypatch):
    """Lines with quoted line ends are sorted by split once, whatever state a split starts in, and stored before any join."""
    plans, kept = [], sales_csv.stored
    monkeypatch.setattr(sales_csv, "stored", lambda spark, df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or kept(spark, df, name))
    rows = sales_csv.scan(*land(HEADER + 'a,2025-03-09,1,1,"1\n\n2",Tienda\n\nb,2025-03-09,2,1,3,Tienda\n'))
    assert [(r.folio, r.registro, r.precio_unitario) for r in rows.orderBy("registro").collect()] == [("a", 2, "1\n\n2"), ("b", 3, "3")]
    assert plans[0].count("Join") == 1 and "LeftSemi" in plans[0]
