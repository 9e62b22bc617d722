"""Validation of e-mail, job and task-event records (the mail set of FIXTURES §3)."""

import json

from pyspark.sql import functions as F

from chunkwise.operators import validate
from chunkwise.operators.records import EMAIL_SPEC, JOB_SPEC, TASK_EVENT_SPEC, validate_records
from chunkwise.schemas import DATA_ENVELOPE_KEYS


def _items(spark, records):
    body = spark.createDataFrame([(json.dumps({"data": records}),)], "body string")
    return validate.explode_envelope(body, "body", DATA_ENVELOPE_KEYS, "data")


def test_emails_default_status_and_invalid_sent(spark):
    mails = [
        {"recipient": "a@x.org", "subject": "hi", "body": "b"},
        {"recipient": "b@x.org", "subject": "hi", "body": "b", "status": "success"},
        {"recipient": "c@x.org", "subject": "hi", "body": "b", "status": "sent"},
        {"recipient": "d@x.org", "subject": "x" * 101, "body": "b"},
    ]
    out = validate_records(_items(spark, mails), EMAIL_SPEC, map_col="item",
                           keep=["item_index"]).orderBy("item_index").collect()
    assert out[0].errors == [] and out[0].status == "processing" and out[0].created_at
    assert out[1].errors == [] and out[1].status == "success" and out[1].sent_at is None
    assert out[2].errors == ["status: must be one of dispatched,failed,processing,success"]
    assert out[3].errors == ["subject: longer than 100"]


def test_jobs_and_task_events(spark):
    jobs = spark.createDataFrame(
        [("j", "{}", "{}", "1.5", None), ("j", "{}", None, "x", "running")],
        "jobName string, input_data string, output_data string, processingTime string, "
        "status string")
    out = validate_records(jobs, JOB_SPEC).collect()
    assert out[0].errors == ["status: must be one of failed,pending,processing,completed"]
    assert set(out[1].errors) == {"output_data: required", "processing_time: invalid value",
                                  "status: must be one of failed,pending,processing,completed"}
    no_status = jobs.drop("status")
    assert validate_records(no_status, JOB_SPEC).first().status == "pending"
    ev = spark.createDataFrame([("t1", "RETRY"), (None, "DONE")], "taskId string, status string")
    out = validate_records(ev, TASK_EVENT_SPEC).collect()
    assert out[0].errors == [] and out[0].task_id == "t1"
    assert set(out[1].errors) == {"task_id: required",
                                  "status: must be one of PENDING,STARTED,SUCCESS,FAILURE,"
                                  "RETRY,REVOKED"}
    valid, rejected = validate.split_valid(validate_records(ev, TASK_EVENT_SPEC))
    assert valid.count() == 1 and rejected.filter(F.size("errors") == 2).count() == 1
