"""Canonical rows of three sources, by hand."""

import datetime

from skillweave.operators.profiles import CAREERS, FREELANCERS, POSTS, canonical

D = datetime.date
EXP = "experiences array<struct<title: string, company: string, description: string, start: date, end: date>>"
EDU = "educations array<struct<institute: string, degree: string, subject: string, start: date, end: date>>"


def test_careers(spark):
    jobs = [("Senior Baker", "Loaf Ltd", "bread", D(2010, 1, 1), D(2012, 1, 1)), ("Cook", "Pan plc", None, D(2012, 2, 1), None), ("Waiter", "Cafe", None, D(2009, 5, 1), D(2008, 1, 1)), ("Chef", "Old", None, None, D(2001, 1, 1))]
    schools = [("College", "BSc", "Food/Drink", D(2001, 1, 1), D(2004, 1, 1)), ("School", None, None, D(1999, 1, 1), None)]
    rows = [
        (1, "en", "Ann", "Head Chef at Inn", "text", " Leeds  UK", "Food", jobs, schools, [("Cooking",)]),
        (2, "en", "Acme Limited", "Head Chef at Inn", None, None, None, jobs[3:], [], []),
        (3, "en", "Bob", "Chef", None, "", "Food", None, None, None), (4, None, None, None, None, None, None, [], [], []),
        (5, "en", "Eve", "Chef at Inn", None, None, None, [jobs[0], jobs[0]], schools[1:], []),
    ]
    df = spark.createDataFrame(rows, f"id long, language string, name string, title string, description string, location string, sector string, {EXP}, {EDU}, skills array<struct<name: string>>")
    out = {x.id: x for x in canonical(df, CAREERS, stop=("the",)).collect()}
    a = out[1]
    assert (a.first_title, a.first_company, a.first_experience_start, a.last_experience_start) == ("Senior Baker", "Loaf Ltd", D(2010, 1, 1), D(2012, 2, 1))
    assert (a.curr_title, a.company, a.nrm_company, a.nrm_first_company) == ("Cook", "Pan plc", "company:careers:en:pan", "company:careers:en:loaf")
    assert a.nrm_first_title == "title:careers:en:baker" and a.first_title_prefix == "senior" and a.title_prefix == "head" and a.parsed_title == "head chef"
    assert (a.last_institute, a.last_degree, a.last_subject) == ("College", "BSc", "Food/Drink") and a.nrm_last_subject == "subject:careers:en:food"
    assert (a.first_education_start, a.last_education_start, a.last_education_end) == (D(1999, 1, 1), D(2001, 1, 1), D(2004, 1, 1))
    assert [(e.start, e.end, e.days) for e in a.experiences] == [(D(2010, 1, 1), D(2012, 1, 1), 730), (D(2012, 2, 1), None, None), (None, None, None), (None, None, None)]
    assert a.skills[0].nrm_name == "skill:careers:en:cook" and a.nrm_sector == "sector:careers:en:food" and a.nrm_location == "leeds uk"
    assert a.text_length == len("Head Chef at Inn" + "text" + "Senior Baker" + "Cook" + "Waiter" + "Chef" + "bread" + "Cooking") and (a.n_experiences, a.n_educations) == (4, 2)
    assert (out[2].curr_title, out[2].company, out[2].first_experience_start, out[2].is_company) == ("Chef", "Old", None, True)
    assert (out[3].curr_title, out[3].company, out[3].n_experiences, out[3].nrm_location) == ("Chef", None, 0, None)
    assert out[4].nrm_title is None and out[4].text_length == 0 and out[4].curr_title is None
    assert (out[5].curr_title, out[5].company, out[5].last_institute, out[5].first_title) == ("Chef", "Inn", "School", "Senior Baker")
    assert canonical(df.limit(0), CAREERS).count() == 0


def test_freelancers_and_posts(spark):
    df = spark.createDataFrame([(1, "en", "Web Developers", "Oslo", [("a", "b", "c", D(2010, 1, 1), None), ("a", "b", "c", D(2009, 1, 1), D(2008, 1, 1)), ("a", "b", "c", D(2011, 1, 1), None)], None)], f"id long, language string, title string, location string, {EXP}, {EDU}")
    x = canonical(df, FREELANCERS).first()
    assert (x.first_experience_start, x.last_experience_start, x.first_education_start) == (D(2010, 1, 1), D(2011, 1, 1), None)
    assert x.nrm_title == "title:freelancers:en:web develop" and x.text_length == len("Web Developers") + 6
    rows = [(1, "en", "Nurses", "Care Ltd", "UK", "Kent", None, "Kent", "Dover", "help", [("First Aid",)]), (2, "en", None, None, None, None, None, None, None, None, None)]
    posts = spark.createDataFrame(rows, "id long, language string, title string, company string, location0 string, location1 string, location2 string, location3 string, location4 string, description string, skills array<struct<name: string>>")
    y, z = sorted(canonical(posts, POSTS).collect(), key=lambda r: r.id)
    assert (y.nrm_title, y.nrm_company, y.nrm_location, y.text_length) == ("job_title:posts:en:nurs", "company:posts:en:care", "dover, kent, uk", 6 + 4 + 9)
    assert (z.nrm_title, z.nrm_location, z.text_length) == (None, None, 0)
