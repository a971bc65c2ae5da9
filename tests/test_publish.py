"""The four extracts on fixtures, run through states, files, history and control table."""

import glob
from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from fixtures import (
    CONFIG,
    NOW,
    day,
    detail,
    eligibility_inputs,
    header,
    header_inputs,
    lab,
    lab_inputs,
    line_inputs,
    span,
)
from pyspark.sql import functions as F

from loomfeed.operators.rules import reference_list
from loomfeed.plans import layouts, publish
from loomfeed.plans.claim_headers import (
    claim_header_current,
    claim_header_source,
    claim_header_state,
)
from loomfeed.plans.claim_lines import claim_line_current, claim_line_source, claim_line_state
from loomfeed.plans.config import EXTENDED, RunConfig
from loomfeed.plans.eligibility import eligibility
from loomfeed.plans.labs import lab_current
from loomfeed.sources.snapshots import read_snapshot, write_snapshot

DOMAINS = ("eligibility", "lab_result", "medclaim_details", "medclaim_header")


@pytest.fixture(autouse=True, scope="module")
def interpreted(spark):
    """A handful of rows do not repay compiling code for a hundred columns."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.unset("spark.sql.codegen.factoryMode")


@pytest.fixture
def store(spark, folder):
    database = "db_" + folder.rsplit("-", 1)[-1].lower()
    spark.sql(f"CREATE DATABASE {database}")
    store = publish.Store(spark, folder, database)
    control = spark.createDataFrame(
        [("inscope_patient", day("2024-06-01"), None)]
        + [(d, day("2024-05-01"), day("2024-04-01")) for d in DOMAINS],
        "file_name string, last_extract_dt timestamp_ntz, previous_last_extract_dt timestamp_ntz",
    )
    write_snapshot(control, store.control, day("2024-06-01"))
    return store


def lines_of(store, report, batch=1):
    folder = store.extract(report, batch)
    texts = [open(f, encoding="utf-8").read() for f in glob.glob(f"{folder}/*.txt")]
    assert len({t.split("\n")[0] for t in texts}) == 1
    return sorted(line for t in texts for line in t.split("\n")[1:] if line)


def test_eligibility_run(spark, store):
    spans = [
        span(1, aud_upd_dt=day("2024-05-09")),
        span(2, primary_coverage_flg="Y", health_plan_card_id=' "q" '),
        span(3, source_patient_id="P9"),
        span(4, source_patient_id="P2", del_ind=1),
        span(5, source_patient_id="P2", record_end_dt=day("2020-01-01")),
        span(6, record_start_dt=day("1850-01-01"), provider_group_id="-1", enrollment_pcp_id="-1"),
    ]
    publish.run_eligibility(store, CONFIG, eligibility_inputs(spark, spans), NOW)
    sent = lines_of(store, "NYFILE_Delta_Eligibility_240501_240601")
    assert len(sent) == 4  # P1 has two live cohort rows, as the cohort table was given
    assert all('"\\"q\\""' in s or "1900-01-01 00:00:00.000" in s for s in sent)
    history = spark.table(store.history("eligibility"))
    assert history.columns == [*layouts.ELIGIBILITY, "Filename", "LoadTime", "LoadDate", "Batch"]
    assert {r.LoadDate for r in history.collect()} == {"20240610"}
    source = read_snapshot(spark, store.state("eligibility"))
    assert source.count() == 3
    control = {r.file_name: tuple(r)[1:] for r in read_snapshot(spark, store.control).collect()}
    assert control["eligibility"] == (day("2024-06-01"), day("2024-04-01"))
    assert control["lab_result"] == (day("2024-05-01"), day("2024-04-01"))


def test_eligibility_lists_tenants_and_extra_rows(spark):
    table = spark.createDataFrame(
        [("Y", "LINE_OF_BUSINESS", "Eligibility", "ALL", "ALL", "PPO", "HMO,PPO")],
        "active_flg string, reference string, domain string, consumer string, market string, "
        "value_exclusion string, value_inclusion string",
    )

    def listed(kind):
        return reference_list(table, "ny", "eligibility", "line_of_business", "", kind)

    spans = [span(1), span(2, source_patient_id="P2", line_of_business="ppo"), span(3, tenant_sk=2)]
    lists = {"lob_include": listed("inclusion"), "lob_exclude": listed("exclusion")}
    cohort = spark.createDataFrame(
        [("P1", 1, "MAIN", 0), ("P1", 2, "MAIN", 0), ("P2", 1, "MAIN", 0)],
        "source_patient_id string, tenant_sk int, projectabbr string, del_ind int",
    )
    inputs = eligibility_inputs(spark, spans, cohort=cohort, **lists)
    both = replace(CONFIG, tenants=(1, 2))
    result = eligibility(both, inputs)
    assert rows(result.history, "TENANT_SK", "SOURCE_SYSTEM_SK", "Entity_Member_Id") == [(0, "0", "P1")]
    other = result.source.withColumn("ENTITY_MEMBER_ID", F.lit("P2"))
    more = eligibility(both, replace(inputs, extra=other))
    assert rows(more.delta, "Entity_Member_Id") == [("P1",), ("P2",)]


def test_lab_runs(spark, store):
    first = [
        lab(1, lab_result_value_raw="4"),
        lab(2, lab_result_sequence=2, result_comment="a|b\té"),
        lab(3, lab_order_id="O2", loinc_cd=None),
        lab(4, lab_order_id="O3", patient_sk=2),
        lab(5, lab_order_id="O4", source_system_sk="30"),
        lab(6, lab_order_id="O5"),
        lab(7, lab_order_id="O5", lab_result_sequence=None, lab_result_value_raw="null first"),
    ]
    publish.run_labs(store, CONFIG, lab_inputs(spark, first), NOW)
    report = "NYFILE_Delta_Lab_240501_240601"
    sent = lines_of(store, report)
    assert len(sent) == 2
    assert sent[0].startswith("Twenty|0|0|P1|Lee,Ann|")  # trailing blank cleaned in the file
    assert "|ab|" in sent[0] and "1EG4" in sent[0]
    assert "null first" in sent[1]

    second = [*first[:2], lab(6, lab_order_id="O5", lab_result_sequence=3), lab(8, lab_order_id="O8")]
    later = NOW + timedelta(days=1)
    publish.run_labs(store, CONFIG, lab_inputs(spark, second), later)
    state = read_snapshot(spark, store.state("lab_result"))
    assert rows(state, "LAB_ORDER_NUMBER", "LAB_RESULT_SK", "_change_type") == [
        ("O1", 2, None),
        ("O5", 6, "update_postimage"),
        ("O8", 8, "insert"),
    ]
    assert len(lines_of(store, "NYFILE_Delta_Lab_240601_240601", 2)) == 2
    assert spark.table(store.history("lab_result")).count() == 4

    publish.run_labs(store, CONFIG, lab_inputs(spark, second), later + timedelta(days=1))
    assert lines_of(store, "NYFILE_Delta_Lab_240601_240601", 3) == []
    assert len(lines_of(store, "NYFILE_Delta_Lab_240601_240601", 2)) == 2


def test_lab_names_by_model(spark):
    current = lab_current(CONFIG, lab_inputs(spark, [lab(1)]))
    assert rows(current, "FIRST_NAME", "MIDDLE_NAME", "LAST_NAME") == [("Ann", None, "Lee")]
    from loomfeed.plans.labs import lab_extract

    state = current.withColumn("_change_type", F.lit("insert"))
    assert rows(lab_extract(CONFIG, state).delta, "PATIENT_NAME") == [("Lee,Ann ",)]
    extended = replace(CONFIG, model=EXTENDED)
    assert rows(lab_extract(extended, state).delta, "PATIENT_NAME") == [("Lee,Ann",)]


@pytest.mark.parametrize("salts", [1, 3])
def test_claim_line_scope(spark, salts):
    headers = [
        header(1),
        header(2, source_patient_id="P2"),
        header(3, source_patient_id="P2", serv_from_dt=day("2024-04-30")),
        header(4, source_patient_id="P3"),
        header(5, final_status_flg="N"),
        header(6, serv_from_dt=day("2020-01-01")),
        header(7, aud_upd_dt=day("2019-01-01")),
        header(8, aud_upd_dt=None),
    ]
    old = {"aud_upd_dt": day("2019-01-01")}
    details = [
        *[detail(10 + n, n, 1) for n in range(1, 7)],
        detail(71, 7, 1, **old),
        detail(72, 7, 2, procedure_code_sk=1, **old),
        detail(73, 7, 3, procedure_code_sk=2, **old),
        detail(74, 7, 4, procedure_code_sk=3, **old),
        detail(75, 7, 5, serv_from_dt=None),
        detail(76, 7, 6, tenant_sk=2),
        detail(77, 7, 7, source_system_sk="30"),
        detail(81, 8, 1, aud_upd_dt=None),
        detail(82, 8, 2, aud_upd_dt=None, procedure_code_sk=1),
    ]
    procedures = [
        {"claim_procedure_sk": 1, "aud_upd_dt": day("2024-05-02")},
        {"claim_procedure_sk": 2, "aud_upd_dt": day("2024-05-02"), "del_ind": 1},
        {"claim_procedure_sk": 3, "aud_upd_dt": day("2019-05-02")},
    ]
    config = replace(CONFIG, salts=salts)
    source = claim_line_source(config, line_inputs(spark, headers, details, procedures))
    assert rows(source, "CLAIM_DETAIL_SK") == [(11,), (13,), (72,), (82,)]


def test_claim_header_values(spark):
    headers = [
        header(1, provider_group_sk="7", rendering_prov_sk=5, source_system_sk="610", adm_dt=day("1753-01-01")),
        header(2, claim_status_cd="9", claim_adjust_type=None, disch_dt=day("8888-12-31"), contract_number=" OCN "),
    ]
    diagnoses = [{"claim_header_sk": 1, "icd_diag_cd_1": " D ", "icd_diag_cd_34": "Z", "diag_code_34_poa": "Y"}]
    details = [detail(11, 1, 1), detail(12, 1, 2, chg_amt=Decimal(5)), detail(13, 1, 3, del_ind=1)]
    inputs = header_inputs(spark, headers, details, diagnoses)
    wanted = (
        "CLAIM_NUMBER CLAIM_STATUS CLAIM_ADJUST_TYPE RENDERING_PROVIDER_GROUP_ID "
        "RENDERING_PROVIDER_ID ICD_DIAG_1 DIAG_CODE_1_POA DIAG_CODE_34_POA"
    ).split()
    source = claim_header_source(CONFIG, inputs)
    assert rows(source, *wanted) == [
        ("20-C2", None, None, "0", "0", None, None, None),
        ("C1", "P", "ORIGINAL", "R7", "N5", "D", "N", "Y"),
    ]
    assert [float(r[0]) for r in rows(source.orderBy("CLAIM_NUMBER"), "CHARGE_AMOUNT")] == [0.0, 15.0]
    extended = claim_header_source(replace(CONFIG, model=EXTENDED), inputs)
    assert rows(extended, *wanted[:3], "ICD_DIAG_1", "CHARGE_AMOUNT", "CONTRACT", "DISCHARGE_DATE") == [
        ("20-C2", "U", "UNK", "UNK", None, "0", None),
        ("C1", "P", "ORIGINAL", "D", "15.00", "0", None),
    ]


def run_claims(spark, store, config, headers, details, now):
    publish.run_claim_lines(store, config, line_inputs(spark, headers, details), now)
    publish.run_claim_headers(store, config, header_inputs(spark, headers, details), now)


def test_claim_runs(spark, store):
    headers = [header(1), header(2), header(3, claim_adjust_type="BACKOUT"), header(4)]
    details = [detail(10 * n, n, 1) for n in range(1, 5)] + [detail(11, 1, 2)]
    run_claims(spark, store, CONFIG, headers, details, NOW)
    assert len(lines_of(store, "NYFILE_Delta_MedClaim_D_240501_240601")) == 5
    assert len(lines_of(store, "NYFILE_Delta_MedClaim_H_240501_240601")) == 4
    state = read_snapshot(spark, store.state("medclaim_header"))
    assert {r.UPDATE_TYPE for r in state.collect()} == {"ORIGINAL"}
    assert {r.UPDATE_TYPE for r in publish.previous_headers(store, state).collect()} == {""}

    # 1: a line changes. 2: the header changes. 3: backout with changed line. 4: deleted.
    # 5: new. A line of 1 that is gone from the source stays in the state and is sent.
    headers = [header(1), header(2, drg_code="9"), headers[2], header(4, del_ind=1), header(5)]
    details = [
        detail(10, 1, 1, ndc_code="N"),
        detail(20, 2, 1),
        detail(30, 3, 1, ndc_code="N"),
        detail(40, 4, 1),
        detail(50, 5, 1),
    ]
    later = NOW + timedelta(days=1)
    config = replace(CONFIG, as_of=date(2024, 6, 11))
    run_claims(spark, store, config, headers, details, later)
    sent = lines_of(store, "NYFILE_Delta_MedClaim_H_240601_240601", 2)
    names = [c.upper() for c in layouts.CLAIM_HEADER[2:]]
    number, kind = names.index("CLAIM_NUMBER"), names.index("CLAIM_ADJUST_TYPE")
    assert [(s.split("|")[number], s.split("|")[kind]) for s in sent] == [
        ("20-C1", "ADJUSTMENT"),
        ("20-C2", "ADJUSTMENT"),
        ("20-C3", "BACKOUT"),
        ("20-C4", "DELETE"),
        ("20-C5", "ORIGINAL"),
    ]
    lines = lines_of(store, "NYFILE_Delta_MedClaim_D_240601_240601", 2)
    assert [tuple(s.split("|")[1:3]) for s in lines] == [
        ("20-C1", "1"),
        ("20-C1", "2"),
        ("20-C2", "1"),
        ("20-C3", "1"),
        ("20-C5", "1"),
    ]
    assert spark.table(store.history("medclaim_header")).count() == 9

    index = read_snapshot(spark, store.state("extracts"))
    assert rows(index, "Filename", "place") == [
        ("NYFILE_Delta_MedClaim_D_240501_240601", "archive"),
        ("NYFILE_Delta_MedClaim_D_240601_240601", "current"),
        ("NYFILE_Delta_MedClaim_H_240501_240601", "archive"),
        ("NYFILE_Delta_MedClaim_H_240601_240601", "current"),
    ]

    # Nothing changed: nothing is sent.
    run_claims(spark, store, config, headers, details, later + timedelta(days=1))
    assert lines_of(store, "NYFILE_Delta_MedClaim_H_240601_240601", 3) == []
    assert lines_of(store, "NYFILE_Delta_MedClaim_D_240601_240601", 3) == []


class Stop(Exception):
    pass


# Where a run may stop: before the call of these, for the n-th time.
STEPS = [("write_extract", 1), ("age_history", 1), ("mark_published", 1)]


def stopped(monkeypatch, step, call, run):
    """Runs until ``step`` is called for the ``call``-th time."""
    with monkeypatch.context() as patch:
        own, calls = getattr(publish, step), []

        def counted(*args, **kwargs):
            calls.append(step)
            if len(calls) == call:
                raise Stop
            return own(*args, **kwargs)

        patch.setattr(publish, step, counted)
        with pytest.raises(Stop):
            run()


def delivered(spark, store, domains, reports):
    """Sent lines, history without its times, and control times."""
    files = [lines_of(store, report) for report in reports]
    history = []
    for domain in domains:
        table = spark.table(store.history(domain)).drop("LoadTime", "LoadDate", "Filename")
        history.append(rows(table, *sorted(table.columns)))
    control = rows(read_snapshot(spark, store.control))
    index = rows(read_snapshot(spark, store.state("extracts")), "Filename", "place")
    return files, history, control, index


@pytest.fixture
def undisturbed(spark, store):
    """A second store with the same control times."""
    folder = store.root + "-undisturbed"
    other = publish.Store(spark, folder, store.database + "_other")
    spark.sql(f"CREATE DATABASE {other.database}")
    write_snapshot(read_snapshot(spark, store.control), other.control, day("2024-06-01"))
    return other


@pytest.mark.parametrize("step, call", STEPS)
def test_labs_repeated_after_a_stop(spark, store, undisturbed, monkeypatch, step, call):
    inputs = lab_inputs(spark, [lab(1), lab(2, lab_order_id="O2")])
    stopped(monkeypatch, step, call, lambda: publish.run_labs(store, CONFIG, inputs, NOW))
    publish.run_labs(store, CONFIG, inputs, NOW + timedelta(days=1))
    publish.run_labs(undisturbed, CONFIG, inputs, NOW)
    args = ["lab_result"], ["NYFILE_Delta_Lab_240501_240601"]
    assert delivered(spark, store, *args) == delivered(spark, undisturbed, *args)
    assert len(lines_of(store, args[1][0])) == 2


@pytest.mark.parametrize("step, call", [("save_state", 2), ("mark_published", 1)])
def test_claims_repeated_after_a_stop(spark, store, undisturbed, monkeypatch, step, call):
    headers, details = [header(1), header(2)], [detail(10, 1, 1), detail(20, 2, 1)]
    def run():
        run_claims(spark, store, CONFIG, headers, details, NOW)

    stopped(monkeypatch, step, call, run)
    run_claims(spark, store, CONFIG, headers, details, NOW + timedelta(days=1))
    run_claims(spark, undisturbed, CONFIG, headers, details, NOW)
    reports = [f"NYFILE_Delta_MedClaim_{x}_240501_240601" for x in "DH"]
    args = ["medclaim_details", "medclaim_header"], reports
    assert delivered(spark, store, *args) == delivered(spark, undisturbed, *args)
    assert [len(lines_of(store, r)) for r in reports] == [2, 2]


def test_lines_repeated_alone_go_out_with_the_headers(spark, store):
    headers, details = [header(1)], [detail(10, 1, 1)]
    for _ in range(2):
        publish.run_claim_lines(store, CONFIG, line_inputs(spark, headers, details), NOW)
    publish.run_claim_headers(store, CONFIG, header_inputs(spark, headers, details), NOW)
    assert len(lines_of(store, "NYFILE_Delta_MedClaim_D_240501_240601")) == 1


def test_newest_header_row_counts(spark):
    """Of rows for one claim and service date the latest update counts, whatever their hashes."""
    for n in range(4):
        pair = [
            header(1, drg_code=f"{n}a", claim_number="C", aud_upd_dt=day("2024-05-01")),
            header(2, drg_code=f"{n}b", claim_number="C", aud_upd_dt=day("2024-05-02")),
        ]
        inputs = header_inputs(spark, pair, [detail(10, 1, 1)])
        current = claim_header_current(CONFIG, inputs)
        lines = line_inputs(spark, pair, [detail(10, 1, 1)])
        state = claim_header_state(
            CONFIG, inputs, current.limit(0), claim_line_state(CONFIG, lines, claim_line_current(CONFIG, lines).limit(0))
        )
        assert rows(state, "DRG_CODE") == [(f"{n}b",)]


def test_tenants_may_share_a_line_number(spark):
    details = [detail(10, 1, 1, source_system_sk="610"), detail(20, 2, 1, source_system_sk="610", tenant_sk=2, claim_number="C1")]
    headers = [header(1, source_system_sk="610"), header(2, source_system_sk="610", tenant_sk=2, claim_number="C1")]
    config = replace(CONFIG, tenants=(1, 2))
    inputs = line_inputs(spark, headers, details)
    current = claim_line_current(config, inputs)
    state = claim_line_state(config, inputs, current.limit(0))
    assert state.count() == current.count()


def test_historic_run_records_deletes_without_sending_them(spark, store):
    config = replace(CONFIG, run_type="Hist")
    headers = [header(1), header(2, del_ind=1)]
    run_claims(spark, store, config, headers, [detail(10, 1, 1), detail(20, 2, 1)], NOW)
    assert len(lines_of(store, "NYFILE_Hist_MedClaim_H_240501_240601")) == 1
    assert spark.table(store.history("medclaim_header")).count() == 2


def test_history_ageing(spark, store):
    today = datetime(2024, 6, 30)
    for age in (364, 366, 729, 731):
        loaded = today - timedelta(days=age)
        publish.record_history(store, "pod", spark.range(2), f"{age}.txt", loaded, batch=age)

    def tiers():
        return [
            sorted({r.Filename for r in spark.table(name).collect()})
            for name in (store.history("pod"), store.archive("pod"))
        ]

    publish.age_history(store, "pod", today)
    assert tiers() == [["364.txt"], ["366.txt", "729.txt"]]
    publish.age_history(store, "pod", today)
    assert tiers() == [["364.txt"], ["366.txt", "729.txt"]]
    assert spark.table(store.archive("pod")).count() == 4
    publish.age_history(store, "pod", today + timedelta(days=2))
    assert tiers() == [[], ["364.txt", "366.txt"]]


def test_config():
    with pytest.raises(ValueError):
        RunConfig("ny", (1,), date(2024, 1, 1), "MAIN", model="other")
