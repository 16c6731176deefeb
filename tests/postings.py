"""Invented payloads: several sources, days, duplicates and gaps."""

import json


def schema_org(url, title, company, place, posted, until=None, salary=None, text="", kind="FULL_TIME"):
    jp = {"@type": "JobPosting", "title": title, "hiringOrganization": {"name": company} if company else None, "jobLocation": [{"address": {"addressLocality": place}}], "datePosted": posted, "validThrough": until, "employmentType": [kind], "description": f"<p>{text}</p>"}
    if salary:
        jp["baseSalary"] = {"currency": "KES", "value": {"minValue": salary[0], "maxValue": salary[1], "unitText": "MONTH"}}
    return {"url": url, "fetched_at": "now", "job_posting": jp, "page_meta": {"og_title": f"{title} in {place}"}}


MYJOBMAG = [
    schema_org(f"https://m.example/job/{i}", t, c, p, d, u, s, x)
    for i, (t, c, p, d, u, s, x) in enumerate(
        [
            ("DATA ANALYST - NAIROBI", "Acme Ltd", "Westlands, Nairobi", "2026-01-02", "2026-01-20", (80000, 120000), "Python, SQL and Power BI. Mail hr@acme.co.ke"),
            ("Software Developer", "Byte Limited", "Thika", "2026-01-03", "2026-01-30", None, "Java or Kotlin. KES 150,000 - 200,000 per month"),
            ("Chef", "Hotel Sea", "Mombasa", "2026-01-03", "2026-01-01", None, "Cook"),
            ("Nurse", None, "Nowhere", None, None, None, "Care"),
            ("Senior Accountant", "Confidential", "Kisumu", "2026-01-04", None, (1, 2), "IFRS and QuickBooks"),
        ]
    )
]
JSEARCH = [
    {"job": {"job_title": "Data Analyst", "employer_name": "ACME", "job_location": "Nairobi, Kenya", "job_min_salary": 2000, "job_max_salary": 3000, "job_salary_period": "month", "required_technologies": ["Python", "Excel"]}, "observed": {"job_id": "x1", "job_apply_link": "https://apply.example/1", "job_posted_at_datetime_utc": "2026-01-05T00:00:00Z"}},
    {"job": {"job_title": "DevOps Engineer", "employer_name": "Cloudy", "job_city": "Nakuru", "job_country": "KE", "job_is_remote": True, "job_min_salary": 2000, "job_salary_string": "USD 2000 a month", "job_salary_period": "month"}, "observed": {"job_id": "x2"}, "id": "js-2"},
]
RELIEFWEB = [{"url": "https://r.example/1", "job": {"title": "Field Officer", "source": [{"name": "Aid Org"}], "city": [{"name": "Garissa"}], "country": [{"name": "Kenya"}], "type": [{"name": "Job"}], "body-html": "<p>Monitoring</p>", "date": {"created": "2026-01-02T00:00:00+00:00", "closing": "2026-02-01T00:00:00+00:00"}}}]
REMOTIVE = [{"job": {"url": "https://v.example/1", "title": "Backend Developer", "company_name": "Far Inc", "candidate_required_location": "Worldwide", "job_type": "contract", "category": "Software", "publication_date": "2026-01-03T10:00:00", "salary": "$60k", "tags": ["python", "django"], "description": "<b>APIs</b>"}}]
ODD = [{"id": 7, "job_posting": {"title": "Odd", "hiringOrganization": ["Plain Name"], "jobLocation": "outside Kenya", "baseSalary": "5"}}]
BY_SOURCE = {"myjobmag": MYJOBMAG, "jsearch": JSEARCH, "reliefweb": RELIEFWEB, "remotive": REMOTIVE, "brightermonday": ODD}


def frame(spark, payloads):
    from pyspark.sql import functions as F

    return spark.createDataFrame([(json.dumps(p),) for p in payloads], "j string").select(F.parse_json("j").alias("payload"))
