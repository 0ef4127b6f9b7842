import contextlib
import io
import json
import os


def plan_text(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def write_json_array(path: str, records: list[dict]) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(records, f, ensure_ascii=False, indent=2)
    return path


def posting_a(**kw) -> dict:
    base = {
        "id": "0", "title": " Data Engineer ", "company_name": " Công ty A ",
        "salary": "10 - 20 triệu", "city": "Hà Nội", "yoe": "3 năm",
        "deadline_submit": "Hạn nộp hồ sơ: 30/08/2025", "main_industry": ["IT"],
        "description": "Build pipelines", "requirements": "Python, SQL, Spark",
        "work_address": "Cầu Giấy", "company_size": "100-499 nhân viên", "major_field": "IT",
        "level": "Nhân viên", "num_of_recruit": "3 người", "work_form": "Toàn thời gian",
        "gender_require": None, "relation_fields": ["Việc làm IT", "Data"],
        "skills": ["Python"], "area": ["Hà Nội", "Cầu Giấy"], "update_time": None,
        "remain_time": None,
    }
    base.update(kw)
    return base


def posting_b(**kw) -> dict:
    base = {
        "jobTitle": "Data Engineer", "companyName": "Company B", "yearsOfExperience": 2,
        "approvedOn": "2025-07-24T10:00:00+07:00", "salaryMin": 1000, "salaryMax": 2000,
        "salaryCurrency": "USD", "companySize": "1,000+",
        "jobFunction": {"parentName": "IT", "children": [{"name": "Data"}, {"name": "BI"}]},
        "jobLevelVI": "Nhân viên", "numberOfRecruits": 2, "typeWorkingId": 1,
        "workingLocations": [{"cityNameVI": "Hồ Chí Minh", "address": "12 Lê Lợi, Quận Tân Bình, HCM"}],
        "skills": [{"skillName": "Python"}, {"skillName": " SQL "}],
    }
    base.update(kw)
    return base
