"""Worked examples of the fields of populations, arms and evidence."""

from __future__ import annotations

from corvane.functions import age, arms, demographics, evidence, standard
from corvane.functions.phrases import column
from corvane.plans.golden import worked


def _text(function):
    return column(function, "string")


worked(
    "population_age",
    ("model", "source"),
    ("age",),
    lambda m, s: {"age": _text(demographics.age)(m, s)},
    [
        ("", "Adults aged 18-65 years", "18-65"),
        ("", "aged between 18 and 65 years", "18-65"),
        ("", "patients aged >= 60 years", "60+"),
        ("", "at least 18 years old", "18+"),
        ("", "65+ outpatients", "65+"),
        ("", "aged 60 or older", "60+"),
        ("", "60 years and over", "60+"),
        ("", "help-seeking 13- to 17-year-olds", "13-17"),
        ("", "mean 45.2 +/- 10.1 years", "45.2+/-10.1"),
        ("", "mean age 45.2±10.1", "45.2+"),
        ("", "mean 40 (sd 7)", "40+/-7"),
        ("", "41.5 years SD 9.2", "41.5+/-9.2"),
        ("", "mean age of 41 in the sample", "41"),
        ("", "median age 40", "Median 40"),
        ("", "ages from 20 to 30", ""),
        ("", "adults from 20 to 30 years", "20-30"),
        ("", "6 to 12 weeks of treatment", ""),
        ("", "20-30", "20-30"),
        ("", "120 patients", ""),
        ("", "n = 44", ""),
        ("", "mothers of children aged 3-5 years", ""),
        ("", "age 44", "44"),
        ("", "elderly outpatients", "Older adults"),
        ("", "parents of adolescents", ""),
        ("", "9th grade students", "9Th Grade Students"),
        ("", "community adults", "Adults"),
        ("Children", "aged 18-65 years", "Children"),
        ("", "", ""),
        (None, None, ""),
        ("45.5", "", "45.5"),
        ("130", "", ""),
    ],
)
worked(
    "population_gender",
    ("model", "source", "men_share", "women_share"),
    ("gender",),
    lambda m, s, a, b: {"gender": column(lambda m, s, a, b: demographics.gender(m, s, "", "", a, b), "string")(m, s, a, b)},
    [
        ("", "12 men and 8 women", "", "", "60% Male + 40% Female"),
        ("", "8 women and 12 men", "", "", "60% Male + 40% Female"),
        ("", "45% male and 55% female", "", "", "45% Male + 55% Female"),
        ("", "62.5% women", "", "", "62.5% Female"),
        ("", "men and women", "", "", "Male + Female"),
        ("", "pregnant patients", "", "", "Female"),
        ("", "adult patients", "", "", ""),
        ("Female", "men", "", "", "Female"),
        ("unknown", "boys", "", "", "Male"),
        ("mostly so", "men", "", "", "mostly so"),
        ("", "adults", "0.4", "0.6", "40% Male + 60% Female"),
        ("", "adults", "33.33", "", "33.3% Male"),
        ("", "adults", "140", "", ""),
        (None, None, None, None, ""),
    ],
)
worked(
    "population_ethnicity",
    ("model", "source"),
    ("ethnicity",),
    lambda m, s: {"ethnicity": _text(demographics.ethnicity)(m, s)},
    [
        ("", "non-Hispanic white women", "White"),
        ("", "non-Hispanic Black", "Black"),
        ("", "Hispanic adults", "Hispanic/Latino"),
        ("", "80% White, 12% African-American", "12% Black + 80% White"),
        ("", "White 70%", "70% White"),
        ("", "Han Chinese and Asian patients", "Asian"),
        ("", "mixed race, other ethnicity", "Mixed + Other"),
        ("", "other illnesses", ""),
        ("Latina", "White", "Hispanic/Latino"),
        ("", "pacific islanders, native american", "Pacific Islander + Indigenous"),
        (None, None, ""),
    ],
)
worked(
    "population_labels",
    ("model", "source"),
    ("occupation", "social_status", "treatment_history"),
    lambda m, s: {n: _text(getattr(demographics, n))(m, s) for n in ("occupation", "social_status", "treatment_history")},
    [
        ("", "Undergraduates and nurses", "College students", "", ""),
        ("", "counselling provided to adults by nurses", "", "", ""),
        ("", "nurses in intensive care", "Nurses", "", ""),
        ("", "7th grade students", "7Th Grade Students", "", ""),
        ("", "pregnant veterans with alcohol use", "", "Pregnant + Veterans + Alcohol use history", ""),
        ("", "mothers of preterm infants", "", "Mothers of preterm infants", ""),
        ("", "HIV-positive smokers", "", "HIV-positive + Smoking history", ""),
        ("", "previously untreated, drug-free", "", "", "Previously untreated + Medication-free"),
        ("", "no prior treatment", "", "", "Treatment-naive + Prior treatment"),
        ("Farmers", "rural adults", "Farmers", "Farmers + Rural", "Farmers"),
        ("Teachers", "", "Teachers", "", ""),
        ("pregnant", "", "", "Pregnant", ""),
        ("unmedicated", "", "", "", "Medication-free"),
        ("unknown", "", "", "", ""),
        (None, None, "", "", ""),
    ],
)
worked(
    "population_focus",
    ("raw",),
    ("focus", "populated", "needs_model"),
    lambda raw: demographics.fields(raw, raw),
    [
        ("Adults", "Adults", 1, False),
        ("Women with depression", "Women", 1, False),
        ("120 patients aged 18-65 years", "aged 18-65 years || 18-65 years", 1, True),
        ("Patients with MADRS >= 20; Nurses", "Nurses", 1, False),
        ("depression", "", 0, False),
        ("Veterans; 60% men and 40% women", "Veterans; || 60% men and 40% women", 2, False),
        ("", "", 0, False),
        (None, "", 0, False),
    ],
)
worked(
    "arm_full_labels",
    ("text", "kind"),
    ("label", "dose"),
    lambda t, k: {"label": arms.arm_label(t, k), "dose": arms.dose_label(t)},
    [
        ("Esketamine 84 mg nasal spray", "Drug", "Esketamine||nasal spray|84 mg", "84 mg"),
        ("Venlafaxine XR 75 mg/day", "Drug", "Venlafaxine|ER||75 mg/day", "75 mg/day"),
        ("TAU", "", "Usual care", ""),
        ("waiting-list", "", "Waitlist", ""),
        ("normal saline", "", "Placebo", ""),
        ("CBT plus sertraline 50mg once daily", "", "CBT + Sertraline|||50 mg/day", "50 mg/day"),
        ("sham tDCS", "", "Sham", ""),
        ("rTMS", "", "rTMS", ""),
        ("Bupropion SR tablets 150 mg b.i.d.", "Drug", "Bupropion|SR|oral tablet|150 mg BID", "150 mg BID"),
        ("received ketamine 0.5 mg/kg infusion", "Drug", "Ketamine||IV infusion|0.5 mg/kg", "0.5 mg/kg"),
        ("lu aa21004", "Drug", "Vortioxetine|||", ""),
        ("XY-1234 hydrochloride", "Drug", "XY-1234|||", ""),
        ("yoga / music therapy", "", "Yoga + Music therapy", ""),
        ("walking group", "", "walking", ""),
        ("olanzapine 5 mg and fluoxetine 20 mg capsules", "Drug", "Olanzapine||oral capsule|5 mg + Fluoxetine||oral capsule|5 mg", "5 mg"),
        ("500 ug vitamin D3", "", "Vitamin D|||500 mcg", "500 mcg"),
        ("", "Drug", "", ""),
        (None, None, "", ""),
    ],
)
worked(
    "evidence_indication",
    ("raw", "context"),
    ("indication",),
    lambda r, c: {"indication": _text(evidence.indication)(r, c)},
    [
        ("MDD in adults", "", "major depressive disorder"),
        ("postpartum depression", "", "Peripartum Depression"),
        ("depression and anxiety", "", "depression || anxiety"),
        ("treatment-resistant depression with chronic pain", "", "treatment-resistant depression || chronic pain"),
        ("major depressive disorder", "patients with insomnia", "major depressive disorder || insomnia"),
        ("insomnia", "", "insomnia"),
        ("healthy volunteers", "cancer", "healthy volunteers"),
        ("women", "cancer", "cancer"),
        ("women", "", ""),
        ("stroke recovery", "", "stroke recovery"),
        ("MDD with melancholic features", "", "Melancholic Depression"),
        ("dysthymia", "", "dysthymic disorder"),
        ("", "", ""),
        (None, None, ""),
    ],
)
worked(
    "evidence_outcome",
    ("raw", "told"),
    ("direction",),
    lambda r, t: {"direction": _text(evidence.outcome)(r, t)},
    [
        ("improved", "", "Positive"),
        ("no change", "", "Neutral"),
        ("worse", "", "Negative"),
        ("mixed", "", "Mixed or Unknown"),
        ("", "Scores did not differ between groups", "Neutral"),
        ("", "Remission was more frequent with the drug", "Positive"),
        ("", "Symptoms were reduced in depression scores", "Positive"),
        ("", "Depression worsened", "Negative"),
        ("", "Response was seen but adverse events occurred", "Mixed or Unknown"),
        ("", "Results were inconclusive despite remission", "Mixed or Unknown"),
        ("", "", "Mixed or Unknown"),
        (None, None, "Mixed or Unknown"),
    ],
)
worked(
    "evidence_sample_size",
    ("raw", "context", "intervention", "comparator"),
    ("size",),
    lambda r, c, i, o: {"size": column(lambda r, c, i, o: evidence.sample_size(r, c, not evidence.about_one_arm(i, o, "")), "string")(r, c, i, o)},
    [
        ("1,234", "", "", "", "1234"),
        ("n = 45", "", "", "", "45"),
        ("120 patients", "", "", "", "120"),
        ("randomized 80 adults", "", "", "", "80"),
        ("A (n=20), B (n=22)", "", "", "", "42"),
        ("A (n=20), B (n=22)", "", "drug", "placebo", ""),
        ("completed n=20 and n=22", "", "", "", ""),
        ("", "A total sample of 300 was planned", "", "", ""),
        ("", "total participants: 300", "", "", "300"),
        ("", "150 participants were seen", "drug", "drug", "150"),
        ("", "150 participants were seen", "drug", "placebo", ""),
        ("", "90 patients completed; 100 adults began", "", "", ""),
        (None, None, None, None, ""),
    ],
)
worked(
    "evidence_follow_up",
    ("raw", "context"),
    ("follow_up",),
    lambda r, c: {"follow_up": _text(evidence.follow_up)(r, c)},
    [
        ("12 weeks", "", "12 weeks"),
        ("1 month", "", "1 month"),
        ("six months", "", "6 months"),
        ("8-12 weeks", "", "8-12 weeks"),
        ("4 weeks and 6 months", "", "6 months"),
        ("12-month", "", "12 months"),
        ("baseline, week 4", "follow-up of 8 weeks", "8 weeks"),
        ("session 1 day", "", ""),
        ("", "followed patients for 2 years", "2 years"),
        ("", "at 6 months follow-up and 12 months post-treatment", "12 months"),
        ("", "an 8 week trial", ""),
        (None, None, ""),
    ],
)
worked(
    "evidence_traces",
    ("raw", "population", "context"),
    ("severity", "treatment_history"),
    lambda r, p, c: {"severity": _text(evidence.severity)(r, p, c), "treatment_history": _text(evidence.treatment_history)(r, p, c)},
    [
        ("moderate to severe depression", "", "", "moderate to severe depression", ""),
        ("HAM-D score > 18", "", "", "HAM-D score > 18", ""),
        ("", "first-episode, drug-naive patients", "", "first-episode", "drug-naive"),
        ("", "", "Remitted patients. Adults with no prior treatment.", "Remitted", "no prior treatment"),
        ("", "", "To assess untreated patients", "", ""),
        ("mild", "mild", "severe", "mild || severe", ""),
        (None, None, None, "", ""),
    ],
)
worked(
    "evidence_population",
    ("raw", "context"),
    ("population",),
    lambda r, c: {"population": _text(evidence.population)(r, c)},
    [
        ("120 women aged 18-45 years", "", "women aged 18-45 years"),
        ("Patients with major depressive disorder", "", "Patients with major depressive disorder"),
        ("Adolescents", "", "Adolescents"),
        ("", "Pregnant women living in rural areas were seen.", "Pregnant women living in rural areas were seen"),
        ("To compare two drugs", "", ""),
        ("nurses; veterans; women; aged 18-65 years", "", "nurses; veterans; women; aged 18-65 years"),
        (None, None, ""),
    ],
)
worked(
    "evidence_snippet",
    ("raw", "context"),
    ("snippet", "phase", "source"),
    lambda r, c: {"snippet": _text(evidence.evidence)(r, c), "phase": _text(evidence.phase)(r, c), "source": _text(evidence.source_index)(r)},
    [
        ("Scores improved (p < 0.05).", "", "Scores improved (p < 0.05).", "", "0"),
        ("We aimed to assess mood.", "Remission was higher than with placebo. Phase 2/3 trial.", "Remission was higher than with placebo.", "Phase 2/3", "We aimed to assess mood."),
        ("12", "", "", "", "12"),
        ("record 7", "a phase II study", "", "Phase II", "7"),
        (None, None, "", "", ""),
    ],
)
worked(
    "evidence_types",
    ("kind", "name"),
    ("type", "target"),
    lambda k, n: {"type": _text(evidence.intervention_type)(k, n), "target": column(lambda k, n: evidence.target(n, k, "depression"), "string")(k, n)},
    [
        ("drug", "sertraline", "Drug", "sertraline"),
        ("", "CBT plus sertraline", "Combination Product", "CBT plus sertraline"),
        ("", "CBT plus usual care", "Behavioral", "CBT plus usual care"),
        ("psychotherapy", "talk", "Behavioral", "talk"),
        ("", "NMDA receptor", "Other", "NMDA receptor"),
        ("", "patients in a trial", "Other", ""),
        ("", "depression pathway", "Other", "depression pathway"),
        ("BDNF", "BDNF", "Other", ""),
        (None, None, "Other", ""),
    ],
)
worked(
    "age_readings",
    ("text",),
    ("kind", "method", "confidence", "lower", "upper", "center", "scale"),
    lambda t: age.parse(t),
    [
        ("18-65", "numeric_range", "range_to_uniform_interval", "high", 18.0, 65.0, 41.5, 13.6),
        ("45.2+/-10.1", "mean_sd", "reported_mean_sd_to_normal_interval", "high", 35.1, 55.3, 45.2, 10.1),
        ("mean 40, sd 8", "mean_sd", "reported_mean_sd_to_normal_interval", "high", 32.0, 48.0, 40.0, 8.0),
        ("Median 40", "median", "median_default_sd_to_normal_interval", "medium", 30.0, 50.0, 40.0, 10.0),
        ("median 40 (18-65)", "median", "median_with_range_to_bounded_normal_interval", "medium_high", 18.0, 65.0, 40.0, 10.0),
        ("mean age 2", "mean", "mean_default_sd_to_normal_interval", "medium", 1.0, 3.0, 2.0, 1.0),
        ("65+", "lower_bound", "open_lower_bound_to_uniform_interval", "low", 65.0, 100.0, 82.5, 10.1),
        ("under 12", "upper_bound", "open_upper_bound_to_uniform_interval", "low", 0.0, 12.0, 6.0, 3.5),
        ("6 months", "single_value", "single_value_to_point_interval_unit_scaled_to_years", "high", 0.5, 0.5, 0.5, 0.0),
        ("Older adults", "age_term", "mapping_library:broad_stage", "medium", 60.0, 79.0, 69.0, 6.0),
        ("Students", "age_term", "mapping_library:education_proxy", "medium", 18.0, 25.0, 21.0, 2.5),
        ("early-onset", "age_term_manual_review", "mapping_library:noise", "very_low", None, None, None, None),
        ("some people", "unknown", "unmapped", "very_low", None, None, None, None),
        ("", "", "", "", None, None, None, None),
        (None, "", "", "", None, None, None, None),
    ],
)
worked(
    "standard_cells",
    ("severity", "social", "occupation", "gender"),
    ("severity_cell", "social_text", "occupation_text", "male"),
    lambda s, o, w, g: {
        "severity_cell": standard.severity_cell(s),
        "social_text": standard.social_text(o),
        "occupation_text": standard.occupation_text(w),
        "male": standard.fixed(standard.male_proportion(g)),
    },
    [
        ("mild to moderate", "pregnant; veterans", "University students", "60% Female", "[2,1]", "Pregnant || Veterans", "Student", "0.40"),
        ("first-episode", "", "Farmers", "45% Male + 55% Female", "first-episode", "", "Farmers", "0.45"),
        ("PHQ-9 >= 10", "mothers of infants", "pregnant women", "Male + Female", "[3,2]", "Mothers of infants", "pregnant women", ""),
        ("severe", "homeless || rural", "HIV clinic", "Male", "3", "Homeless || Rural", "", "1.00"),
        ("HAM-D score > 24", "plain", "nurses and teachers", "female", "3", "", "Nurse || Teacher", "0.00"),
        ("MADRS > 6", "smokers", "untreated", "", "[3,2,1]", "Smoking history", "", ""),
        (None, None, None, None, "", "", "", ""),
    ],
)
