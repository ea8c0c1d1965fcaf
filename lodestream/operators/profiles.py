"""Personal profiles: one struct from a source's JSON, and files of an application made from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.functions import docx
from lodestream.functions import fixed_values as fixed
from lodestream.functions import text as T
from lodestream.operators import bundle, content

_SPAN = "dateRange: struct<start: struct<month: int, year: int>, end: struct<month: int, year: int>>"
_NAMES = "struct<elements: array<struct<name: string>>>"
PROFILE = (
    "elements array<struct<firstName: string, lastName: string, headline: string, summary: string, geoLocation: struct<geo: struct<defaultLocalizedName: string>>, location: struct<geo: struct<defaultLocalizedName: string>>, "
    f"profilePositionGroups: struct<elements: array<struct<name: string, company: struct<name: string>, profilePositionInPositionGroup: struct<elements: array<struct<title: string, companyName: string, locationName: string, geoLocationName: string, description: string, {_SPAN}>>>>>>, "
    f"profileEducations: struct<elements: array<struct<school: struct<name: string>, schoolName: string, degreeName: string, fieldOfStudy: string, description: string, {_SPAN}>>>, "
    f"profileSkills: {_NAMES}, profileLanguages: {_NAMES}, profileCertifications: {_NAMES}, profileVolunteerExperiences: struct<elements: array<struct<role: string, companyName: string, description: string>>>>>"
)


def _text(*cols: Column) -> Column:
    return F.coalesce(T.or_else(*cols), F.lit(""))


def _dates(x: Column) -> list[Column]:
    day = lambda k: T.month_year(x["dateRange"][k]["month"], x["dateRange"][k]["year"])
    return [day("start").alias("start"), day("end").alias("end")]


def _latest_first(entries: Column) -> Column:
    """By falling start; equal ones in their order."""
    keyed = F.transform(entries, lambda x, i: F.struct((-T.date_rank(x["start"])).alias("k"), i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda y: y["x"])


def parse(profiles: DataFrame) -> DataFrame:
    """profiles: (id, body JSON of a full profile). Positions and education by falling start; absent lists are empty."""
    out = profiles.select("id", F.get(F.from_json("body", PROFILE)["elements"], F.lit(0)).alias("p"))
    names = lambda k: F.filter(F.transform(F.col(f"p.{k}.elements"), lambda e: F.coalesce(e["name"], F.lit(""))), lambda n: n != "")
    groups = F.transform(F.col("p.profilePositionGroups.elements"), lambda g: F.transform(g["profilePositionInPositionGroup"]["elements"], lambda x: F.struct(_text(x["title"]).alias("title"), _text(x["companyName"], g["company"]["name"], g["name"]).alias("company"), _text(x["locationName"], x["geoLocationName"]).alias("location"), *_dates(x), _text(x["description"]).alias("description"))))
    positions = F.flatten(F.filter(groups, lambda g: g.isNotNull()))
    schools = F.transform(F.col("p.profileEducations.elements"), lambda e: F.struct(_text(e["school"]["name"], e["schoolName"]).alias("school"), _text(e["degreeName"]).alias("degree"), _text(e["fieldOfStudy"]).alias("field"), *_dates(e), _text(e["description"]).alias("description")))
    helps = F.filter(F.transform(F.col("p.profileVolunteerExperiences.elements"), lambda e: F.struct(_text(e["role"]).alias("role"), _text(e["companyName"]).alias("organization"), _text(e["description"]).alias("description"))), lambda e: (e["role"] != "") | (e["organization"] != ""))
    out = out.select(
        "id", F.trim(F.concat(_text(F.col("p.firstName")), F.lit(" "), _text(F.col("p.lastName")))).alias("full_name"), _text(F.col("p.headline")).alias("headline"), _text(F.col("p.geoLocation.geo.defaultLocalizedName"), F.col("p.location.geo.defaultLocalizedName")).alias("location"), _text(F.col("p.summary")).alias("summary"),
        _latest_first(positions).alias("positions"), _latest_first(schools).alias("education"), names("profileSkills").alias("skills"), names("profileLanguages").alias("languages"), names("profileCertifications").alias("certifications"), helps.alias("volunteer"),
    )
    lists = ("positions", "education", "skills", "languages", "certifications", "volunteer")
    return out.withColumns({c: F.coalesce(c, F.from_json(F.lit("[]"), out.schema[c].dataType)) for c in lists})


_JOB = "array<struct<title: string, position: string, company: string, company_name: string, location: string, start_date: string, start: string, end_date: string, end: string, description: string>>"
_SCHOOL = "array<struct<school: string, institution: string, degree: string, degree_name: string, field: string, field_of_study: string, start_date: string, start: string, end_date: string, end: string, description: string>>"
FLAT = (
    "full_name string, name string, headline string, title string, location string, summary string, about string, "
    f"experience {_JOB}, positions {_JOB}, education {_SCHOOL}, skills array<string>, languages array<string>, certifications array<string>"
)


def _named(items: Column) -> Column:
    """Names of bare texts or of objects with a name."""
    name = lambda x: F.when(x.startswith("{") & F.get_json_object(x, "$").isNotNull(), F.get_json_object(x, "$.name")).otherwise(x)
    return F.coalesce(F.transform(items, lambda x: F.coalesce(name(x), F.lit(""))), F.array().cast("array<string>"))


def parse_flat(profiles: DataFrame) -> DataFrame:
    """profiles: (id, body JSON of a flat profile, bare or under `data`). The columns of `parse`; entries stay in the order given, names may be empty, and there is no voluntary work."""
    body = T.or_else(F.get_json_object("body", "$.data"), F.col("body"))
    out = profiles.select("id", F.from_json(body, FLAT).alias("p"))
    p = lambda k: F.col(f"p.{k}")
    dates = lambda x: [T.or_else(x["start_date"], x["start"]).alias("start"), T.or_else(x["end_date"], x["end"]).alias("end")]
    job = lambda x: F.struct(_text(x["title"], x["position"]).alias("title"), _text(x["company"], x["company_name"]).alias("company"), _text(x["location"]).alias("location"), *dates(x), _text(x["description"]).alias("description"))
    school = lambda x: F.struct(_text(x["school"], x["institution"]).alias("school"), _text(x["degree"], x["degree_name"]).alias("degree"), _text(x["field"], x["field_of_study"]).alias("field"), *dates(x), _text(x["description"]).alias("description"))
    out = out.select(
        "id", _text(p("full_name"), p("name")).alias("full_name"), _text(p("headline"), p("title")).alias("headline"), _text(p("location")).alias("location"), _text(p("summary"), p("about")).alias("summary"),
        F.transform(F.coalesce(p("experience"), p("positions")), job).alias("positions"), F.transform(p("education"), school).alias("education"), _named(p("skills")).alias("skills"), _named(p("languages")).alias("languages"), _named(p("certifications")).alias("certifications"),
        F.array().cast("array<struct<role: string, organization: string, description: string>>").alias("volunteer"),
    )
    return out.withColumns({c: F.coalesce(c, F.from_json(F.lit("[]"), out.schema[c].dataType)) for c in ("positions", "education")})


def profile_texts(parsed: DataFrame) -> DataFrame:
    """The columns of `parse` with counts, points and readable texts of the lists."""
    some = lambda c: F.nullif(c, F.lit(""))
    below = lambda c: F.concat(F.lit("\n"), some(c))
    between = " \u2014 "
    job = lambda x: F.concat_ws("\n", F.concat(x["title"], F.when(x["company"] != "", F.concat(F.lit(" @ "), x["company"])).otherwise("")), F.concat_ws(between, x["start"], F.coalesce(x["end"], F.lit("Present"))), some(x["location"]), below(x["description"]))
    school = lambda x: F.concat_ws("\n", x["school"], some(F.concat_ws(", ", some(x["degree"]), some(x["field"]))), some(F.concat_ws(between, x["start"], x["end"])), below(x["description"]))
    help_ = lambda x: F.concat_ws("\n", x["role"], F.concat(F.lit("@ "), some(x["organization"])), below(x["description"]))
    texts = {"experience_text": F.array_join(F.transform("positions", job), "\n\n---\n\n"), "education_text": F.array_join(F.transform("education", school), "\n\n"), "volunteer_text": F.array_join(F.transform("volunteer", help_), "\n\n")}
    joined = {f"{c}_text": F.array_join(c, ", ") for c in ("skills", "languages", "certifications")}
    counts = {"experience_count": F.size("positions"), "education_count": F.size("education"), "skills_count": F.size("skills")}
    return parsed.withColumns(texts | joined | counts | {"completeness_score": bundle.completeness()})


def stopped_at(tries: DataFrame, failures: int = 3) -> DataFrame:
    """(entity_name, stop): the number of the row at which a run has failed so many times in a row, for runs that have; later rows are not tried. tries: (entity_name, _i from 0, failed). No window over a run: each failure counts for the rows that it may end a series at."""
    ends = tries.where("failed").select("entity_name", F.explode(F.sequence(F.col("_i"), F.col("_i") + failures - 1)).alias("_i"))
    whole = ends.groupBy("entity_name", "_i").agg(F.count("*").alias("n")).where(F.col("n") == failures)
    return whole.groupBy("entity_name").agg(F.min("_i").alias("stop"))


def scraped(wanted: DataFrame, first: DataFrame, second: DataFrame, fallback: bool = True, failures: int = 3) -> DataFrame:
    """A row for each wanted profile, from the first service, or else the second.

    wanted: (id, run, pool_pos, entity_name, url), numbered within the run, one session (null is one too), by pool_pos. first: (id, body), a full
    profile; an answer that is missing or has no elements is a failure, and after `failures` of them in a row the rest of the
    run goes to the second service unasked. second: (url, http_status, body), one row a URL; an answer fails from status 400 on
    and without `success`. Of the first service only profiles that it is asked for are parsed.
    """
    asked = content.numbered(wanted.select("id", F.coalesce(F.col("run").cast("string"), F.lit("")).alias("entity_name"), "pool_pos", F.col("entity_name").alias("who"), "url"))
    elements = F.size(F.from_json(F.get_json_object("body", "$.elements"), "array<string>"))
    asked = asked.join(first.select("id", F.when(elements > 0, F.col("body")).alias("body")), "id", "left")
    stop = stopped_at(asked.select("entity_name", "_i", F.col("body").isNull().alias("failed")), failures)
    asked = asked.join(stop, "entity_name", "left").withColumn("body", F.when(F.col("stop").isNull() | (F.col("_i") <= F.col("stop")), F.col("body")))
    asked = asked.select("id", F.col("who").alias("entity_name"), "url", "body")
    voyager, other, none = fixed.PROFILE_METHODS
    failed = asked.where("body is null").drop("body")
    keys = ["id", "entity_name", "url", "scrape_method", "error"]
    said = failed.withColumn("error", F.lit(fixed.PROFILE_ERRORS["disabled"]))
    good = asked.where("body is not null").select("id", "entity_name", "url", F.lit(voyager).alias("scrape_method"), F.lit(None).cast("string").alias("error"), "body")
    parts = [(good, parse)]
    if fallback:
        get = lambda k: F.get_json_object("body", f"$.{k}")
        ok = (F.coalesce("http_status", F.lit(0)) < 400) & ~F.coalesce(get("success"), F.lit("")).isin("", "false", "0")
        reason = F.format_string(fixed.PROFILE_ERRORS["answer"], F.coalesce(F.col("http_status").cast("string"), F.lit("")), F.coalesce(T.or_else(get("message"), get("error")), F.lit(fixed.PROFILE_ERRORS["unknown"])))
        tried = failed.join(second, "url", "left")
        error = F.when(F.col("body").isNull() & F.col("http_status").isNull(), fixed.PROFILE_ERRORS["none"]).when(~ok, reason)
        tried = tried.select("id", "entity_name", "url", F.lit(other).alias("scrape_method"), error.alias("error"), "body")
        parts.append((tried.where("error is null"), parse_flat))
        said = tried.where("error is not null")
    rows = [profile_texts(of(part.select(F.struct(*keys).alias("id"), "body"))).select("id.*", *_SHOWN, F.when(F.col("completeness_score") < 50, "incomplete").otherwise("success").alias("status")) for part, of in parts]
    out = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
    empty = said.select("id", "entity_name", "url", F.lit(none).alias("scrape_method"), "error", F.col("entity_name").alias("full_name"), F.lit(0).alias("completeness_score"), F.lit("error").alias("status"))
    return out.unionByName(empty, allowMissingColumns=True)


_SHOWN = "full_name headline location summary experience_count education_count skills_count completeness_score experience_text education_text skills_text languages_text certifications_text volunteer_text".split()


def scrape_summary(rows: DataFrame, cost: float = 0.01) -> DataFrame:
    """One row: how many profiles each service gave, how many failed, what the second cost. rows: of `scraped`."""
    voyager, other, _ = fixed.PROFILE_METHODS
    n = lambda m: F.count_if(F.col("scrape_method") == m)
    return rows.agg(F.count("*").alias("total"), n(voyager).alias("first_service"), n(other).alias("second_service"), F.count_if(F.col("status") == "error").alias("failed"), F.count_if(F.col("status") == "incomplete").alias("incomplete"), F.round(n(other) * cost, 2).alias("cost_usd"))


def job_configs(responses: DataFrame) -> DataFrame:
    """(entity_name, company_name, base_variant, config JSON, error) of a model's answers: dashes made plain, unknown variants generic, an error without a company. responses: (entity_name, text)."""
    out = responses.select("entity_name", F.translate(T.model_json(F.col("text")), "\u2013\u2014", "--").alias("config"))
    company, variant = T.or_else(F.get_json_object("config", "$.company_name")), F.get_json_object("config", "$.base_variant")
    error = F.when(F.col("config").isNull(), "no JSON object in the answer").when(company.isNull(), "Missing company_name in AI response")
    return out.select("entity_name", company.alias("company_name"), F.when(error.isNull(), F.when(variant.isin(fixed.JOB_VARIANTS), variant).otherwise("generic")).alias("base_variant"), "config", error.alias("error"))


def application_files(configs: DataFrame) -> DataFrame:
    """(path, content) of the JSON file of each good config, for a text sink. The names are the companies', as file names allow."""
    good = configs.where("error is null")
    return good.select(F.concat(T.file_slug(F.coalesce("company_name", "entity_name")), F.lit("_"), "base_variant", F.lit(".json")).alias("path"), F.col("config").alias("content"))


CONFIG = (
    "company_name string, base_variant string, fit_score double, "
    "job_analysis struct<explicit_requirements: array<struct<requirement: string, priority: string, frequency: int>>, preferred_qualifications: array<string>, industry_language: array<string>, "
    "operational_context: struct<team_size: string, reporting_to: string, scope: string, location: string>, culture_signals: array<string>>, "
    "gaps array<string>, suggestions struct<summary: {one}, highlights: {one}, competencies: {one}, job_bullets: {one}>, "
    "cv struct<summary: string, highlights: array<string>, competencies: array<struct<category: string, items: array<string>>>, otherExp: string, jobs: map<string, struct<role: string, intro: string, bullets: array<string>>>>"
).format(one="struct<has_suggestions: boolean, items: array<struct<type: string, job: string, current: string, suggested: string, addresses: string>>>")

_SUGGESTED = [("summary", "Summary Suggestions"), ("highlights", "Highlights Suggestions"), ("competencies", "Competency Suggestions"), ("job_bullets", "Job Bullet Suggestions")]
_BLUE = "2B5C6E"


def _heading(text) -> Column:
    return docx.paragraph(docx.run(F.lit(text) if isinstance(text, str) else text, 28, _BLUE, bold=True), before=300, after=100)


def _subheading(text) -> Column:
    return docx.paragraph(docx.run(F.lit(text) if isinstance(text, str) else text, 22, "1a1a1a", bold=True), before=200, after=60)


def _label(name: str, value: Column) -> Column:
    return docx.paragraph(docx.run(F.lit(f"{name}: "), color=_BLUE, bold=True), docx.run(value), after=30)


def _rule() -> Column:
    return docx.paragraph(before=60, after=60, rule=True)


def _some(*paragraphs: Column) -> Column:
    """Those that are not null, as an array."""
    return F.filter(F.array(*(p.cast(docx.PARAGRAPHS[6:-1]) for p in paragraphs)), lambda p: p.isNotNull())


def _each(items: Column, make) -> Column:
    return F.coalesce(F.transform(items, make), F.array().cast(docx.PARAGRAPHS))


def _given(text: Column) -> Column:
    return T.or_else(text)


def suggestion_paragraphs(c: Column, made_on: Column, owner: str = "the applicant") -> Column:
    """The document that explains an application: the five layers of the job's analysis, gaps, suggestions. c: a struct of CONFIG."""
    job, context = c["job_analysis"], c["job_analysis"]["operational_context"]
    times = lambda r: F.when(r["frequency"] > 1, F.concat(F.lit(" (mentioned "), r["frequency"].cast("string"), F.lit("x)"))).otherwise("")
    text = lambda x: F.coalesce(x, F.lit(""))
    body = lambda x: docx.paragraph(docx.run(x))
    dashed = lambda xs: _each(xs, lambda x: body(F.concat(F.lit("  - "), text(x))))
    layers = F.concat(
        _some(_heading("5-Layer Job Ad Analysis"), _rule(), _subheading("Layer 1: Explicit Requirements")),
        _each(job["explicit_requirements"], lambda r: body(F.concat(F.lit("  ["), text(r["priority"]), F.lit("] "), text(r["requirement"]), times(r)))),
        _some(_subheading("Layer 2: Preferred Qualifications")), dashed(job["preferred_qualifications"]),
        _some(_subheading("Layer 3: Industry Language & Keywords"), body(F.concat(F.lit("  "), F.coalesce(F.array_join(job["industry_language"], ", "), F.lit("")))), _subheading("Layer 4: Operational Context")),
        _some(*(F.when(_given(context[k]).isNotNull(), _label(name, context[k])) for name, k in (("Team", "team_size"), ("Reports to", "reporting_to"), ("Scope", "scope"), ("Location", "location")))),
        _some(_subheading("Layer 5: Culture Signals")), dashed(job["culture_signals"]),
    )
    none = F.array().cast(docx.PARAGRAPHS)

    def gap(g: Column, i: Column) -> Column:
        of = lambda k: F.get_json_object(g, f"$.{k}")  # noqa: E731  an object or a bare text
        head = F.concat((i + 1).cast("string"), F.lit(". "), F.coalesce(_given(of("requirement")), g), F.lit(" ["), text(of("priority")), F.lit("]"))
        return _some(_subheading(head), F.when(_given(of("closest_match")).isNotNull(), _label("Closest existing content", of("closest_match"))), F.when(_given(of("question")).isNotNull(), _label(f"Question for {owner}", of("question"))))

    gaps = F.when(F.size(c["gaps"]) > 0, F.concat(_some(_heading("Content Gaps"), _rule()), F.flatten(F.transform(c["gaps"], gap)))).otherwise(none)

    def suggestion(x: Column, i: Column) -> Column:
        head = F.concat((i + 1).cast("string"), F.lit(". ["), text(x["type"]), F.lit("]"), F.when(_given(x["job"]).isNotNull(), F.concat(F.lit(" ("), x["job"], F.lit(")"))).otherwise(""))
        return _some(_subheading(head), F.when(_given(x["current"]).isNotNull(), _label("CURRENT", x["current"])), _label("SUGGESTED", x["suggested"]), _label("ADDRESSES", x["addresses"]))

    def section(key: str, title: str) -> Column:
        s = c["suggestions"][key]
        return F.when(s["has_suggestions"] & (F.size(s["items"]) > 0), F.concat(_some(_heading(title), _rule()), F.flatten(F.transform(s["items"], suggestion)))).otherwise(none)

    title = docx.paragraph(docx.run(F.concat(F.lit("CV Analysis & Suggestions - "), text(c["company_name"])), 36, _BLUE, bold=True))
    note = docx.paragraph(docx.run(F.concat(F.lit("Generated "), made_on, F.lit(". Review each suggestion and approve/reject.")), color="666666", italics=True), after=200)
    return F.concat(_some(title, note), F.when(job.isNotNull(), layers).otherwise(none), gaps, *(section(*x) for x in _SUGGESTED))


def cv_paragraphs(c: Column) -> Column:
    """The tailored CV: summary, highlights, competencies, jobs in their order and other experience, each only if given. c: a struct of CONFIG."""
    cv, none = c["cv"], F.array().cast(docx.PARAGRAPHS)
    body = lambda x: docx.paragraph(docx.run(x))
    dashed = lambda xs: _each(xs, lambda x: body(F.concat(F.lit("  - "), F.coalesce(x, F.lit("")))))

    def part(title: str, there: Column, content: Column) -> Column:
        return F.when(there, F.concat(_some(_heading(title), _rule()), content)).otherwise(none)

    competency = lambda x: body(F.concat(F.coalesce(x["category"], F.lit("")), F.lit(": "), F.coalesce(F.array_join(x["items"], ", "), F.lit(""))))
    job = lambda x: F.concat(_some(_subheading(F.concat(F.coalesce(x["value"]["role"], F.lit("")), F.lit(", "), x["key"])), F.when(_given(x["value"]["intro"]).isNotNull(), body(x["value"]["intro"]))), dashed(x["value"]["bullets"]))
    return F.concat(
        part("Summary", _given(cv["summary"]).isNotNull(), _some(body(cv["summary"]))), part("Highlights", F.size(cv["highlights"]) > 0, dashed(cv["highlights"])),
        part("Competencies", F.size(cv["competencies"]) > 0, _each(cv["competencies"], competency)), part("Experience", F.size(cv["jobs"]) > 0, F.flatten(F.transform(F.map_entries(cv["jobs"]), job))),
        part("Other Experience", _given(cv["otherExp"]).isNotNull(), _some(body(cv["otherExp"]))),
    )


def _config() -> Column:
    """The answer as a struct; null where it is no JSON."""
    return F.when(F.get_json_object("config", "$").isNotNull(), F.from_json("config", CONFIG))


def application_documents(configs: DataFrame, made_on: Column | None = None, prefix: str = "CV_") -> DataFrame:
    """(entity_name, pool_pos, name, content binary): the CV and the suggestions as Word documents and the answer as JSON of each entity with an analysis. configs: (entity_name, pool_pos, config JSON). Of entities whose names make the same file the last keeps it, as if written in turn."""
    made_on = F.date_format(F.current_date(), "yyyy-MM-dd") if made_on is None else made_on
    rows = configs.withColumn("c", _config()).where("c is not null")
    slug = T.file_slug(F.coalesce(_given(F.col("c.company_name")), "entity_name"))
    last = rows.withColumn("slug", slug).groupBy("slug").agg(F.max_by(F.struct("entity_name", "pool_pos", "config", "c"), F.struct("pool_pos", "entity_name")).alias("r")).select("slug", "r.*")
    c = F.col("c")
    parts = F.array(
        F.struct(F.concat(F.lit(prefix), "slug", F.lit("_tailored.docx")).alias("name"), cv_paragraphs(c).alias("p")),
        F.struct(F.concat(F.lit("SUGGESTIONS_"), "slug", F.lit(".docx")).alias("name"), suggestion_paragraphs(c, made_on).alias("p")),
        F.struct(F.concat(F.lit("RESPONSE_"), "slug", F.lit(".json")).alias("name"), F.lit(None).cast(docx.PARAGRAPHS).alias("p")),
    )
    files = last.select("entity_name", "pool_pos", "config", F.explode(parts).alias("f")).select("entity_name", "pool_pos", "f.name", "f.p", "config")
    content = F.when(F.col("p").isNotNull(), docx.document("p")).otherwise(F.encode("config", "UTF-8"))
    return files.select("entity_name", "pool_pos", "name", content.alias("content"))


def application_summary(configs: DataFrame, files: DataFrame) -> DataFrame:
    """(entity_name, cv_filename, suggestions_filename, response_filename, variant, fit_score, cv_size_kb, status, error) of each config; an error where there is no analysis. files: of application_documents."""
    of = files.groupBy("entity_name", "pool_pos").agg(*(F.max(F.when(F.col("name").rlike(p), F.col(v))).alias(k) for k, p, v in (("cv_filename", "_tailored\\.docx$", "name"), ("suggestions_filename", "^SUGGESTIONS_", "name"), ("response_filename", "^RESPONSE_", "name"))), F.max(F.when(F.col("name").rlike("_tailored\\.docx$"), F.length("content"))).alias("n"))
    out = configs.withColumn("c", _config()).join(of, ["entity_name", "pool_pos"], "left")
    bad = F.when(F.col("c").isNull(), "No analysis data from job-analyzer").when(F.col("cv_filename").isNull(), "Another entity has the same file name")
    return out.select("entity_name", "cv_filename", "suggestions_filename", "response_filename", F.col("c.base_variant").alias("variant"), F.col("c.fit_score").alias("fit_score"), T.js_round(F.col("n") / 1024).cast("int").alias("cv_size_kb"), F.when(bad.isNull(), "success").otherwise("error").alias("status"), bad.alias("error"))
