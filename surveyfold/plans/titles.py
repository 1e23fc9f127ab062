"""Fixed code lists: occupation minor-group titles, sector titles, citizenship labels.

These are published classification values (SOC 2018 minor groups, NAICS
2-digit sectors, the census citizenship codes) that must equal the values
the reference's outputs carry. Titles are written with plain spaces (the
reference's sector file has non-breaking spaces inside some titles).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# ---------------------------------------------------------------------------
# SOC 2018 minor groups (minor_group, title), in code order.
# The three 55-x groups (military) are part of the classification and are
# removed by the military filter (L7) in the products.
# ---------------------------------------------------------------------------
SOC_MINOR_GROUPS = (
    ("11-1000", "Top Executives"),
    ("11-2000", "Advertising, Marketing, Promotions, Public Relations, and Sales Managers"),
    ("11-3000", "Operations Specialties Managers"),
    ("11-9000", "Other Management Occupations"),
    ("13-1000", "Business Operations Specialists"),
    ("13-2000", "Financial Specialists"),
    ("15-1200", "Computer Occupations"),
    ("15-2000", "Mathematical Science Occupations"),
    ("17-1000", "Architects, Surveyors, and Cartographers"),
    ("17-2000", "Engineers"),
    ("17-3000", "Drafters, Engineering Technicians, and Mapping Technicians"),
    ("19-1000", "Life Scientists"),
    ("19-2000", "Physical Scientists"),
    ("19-3000", "Social Scientists and Related Workers"),
    ("19-4000", "Life, Physical, and Social Science Technicians"),
    ("19-5000", "Occupational Health and Safety Specialists and Technicians"),
    ("21-1000", "Counselors, Social Workers, and Other Community and Social Service Specialists"),
    ("21-2000", "Religious Workers"),
    ("23-1000", "Lawyers, Judges, and Related Workers"),
    ("23-2000", "Legal Support Workers"),
    ("25-1000", "Postsecondary Teachers"),
    ("25-2000", "Preschool, Elementary, Middle, Secondary, and Special Education Teachers"),
    ("25-3000", "Other Teachers and Instructors"),
    ("25-4000", "Librarians, Curators, and Archivists"),
    ("25-9000", "Other Educational Instruction and Library Occupations"),
    ("27-1000", "Art and Design Workers"),
    ("27-2000", "Entertainers and Performers, Sports and Related Workers"),
    ("27-3000", "Media and Communication Workers"),
    ("27-4000", "Media and Communication Equipment Workers"),
    ("29-1000", "Healthcare Diagnosing or Treating Practitioners"),
    ("29-2000", "Health Technologists and Technicians"),
    ("29-9000", "Other Healthcare Practitioners and Technical Occupations"),
    ("31-1100", "Home Health and Personal Care Aides; and Nursing Assistants, Orderlies, and Psychiatric Aides"),
    ("31-2000", "Occupational Therapy and Physical Therapist Assistants and Aides"),
    ("31-9000", "Other Healthcare Support Occupations"),
    ("33-1000", "Supervisors of Protective Service Workers"),
    ("33-2000", "Firefighting and Prevention Workers"),
    ("33-3000", "Law Enforcement Workers"),
    ("33-9000", "Other Protective Service Workers"),
    ("35-1000", "Supervisors of Food Preparation and Serving Workers"),
    ("35-2000", "Cooks and Food Preparation Workers"),
    ("35-3000", "Food and Beverage Serving Workers"),
    ("35-9000", "Other Food Preparation and Serving Related Workers"),
    ("37-1000", "Supervisors of Building and Grounds Cleaning and Maintenance Workers"),
    ("37-2000", "Building Cleaning and Pest Control Workers"),
    ("37-3000", "Grounds Maintenance Workers"),
    ("39-1000", "Supervisors of Personal Care and Service Workers"),
    ("39-2000", "Animal Care and Service Workers"),
    ("39-3000", "Entertainment Attendants and Related Workers"),
    ("39-4000", "Funeral Service Workers"),
    ("39-5000", "Personal Appearance Workers"),
    ("39-6000", "Baggage Porters, Bellhops, and Concierges"),
    ("39-7000", "Tour and Travel Guides"),
    ("39-9000", "Other Personal Care and Service Workers"),
    ("41-1000", "Supervisors of Sales Workers"),
    ("41-2000", "Retail Sales Workers"),
    ("41-3000", "Sales Representatives, Services"),
    ("41-4000", "Sales Representatives, Wholesale and Manufacturing"),
    ("41-9000", "Other Sales and Related Workers"),
    ("43-1000", "Supervisors of Office and Administrative Support Workers"),
    ("43-2000", "Communications Equipment Operators"),
    ("43-3000", "Financial Clerks"),
    ("43-4000", "Information and Record Clerks"),
    ("43-5000", "Material Recording, Scheduling, Dispatching, and Distributing Workers"),
    ("43-6000", "Secretaries and Administrative Assistants"),
    ("43-9000", "Other Office and Administrative Support Workers"),
    ("45-1000", "Supervisors of Farming, Fishing, and Forestry Workers"),
    ("45-2000", "Agricultural Workers"),
    ("45-3000", "Fishing and Hunting Workers"),
    ("45-4000", "Forest, Conservation, and Logging Workers"),
    ("47-1000", "Supervisors of Construction and Extraction Workers"),
    ("47-2000", "Construction Trades Workers"),
    ("47-3000", "Helpers, Construction Trades"),
    ("47-4000", "Other Construction and Related Workers"),
    ("47-5000", "Extraction Workers"),
    ("49-1000", "Supervisors of Installation, Maintenance, and Repair Workers"),
    ("49-2000", "Electrical and Electronic Equipment Mechanics, Installers, and Repairers"),
    ("49-3000", "Vehicle and Mobile Equipment Mechanics, Installers, and Repairers"),
    ("49-9000", "Other Installation, Maintenance, and Repair Occupations"),
    ("51-1000", "Supervisors of Production Workers"),
    ("51-2000", "Assemblers and Fabricators"),
    ("51-3000", "Food Processing Workers"),
    ("51-4000", "Metal Workers and Plastic Workers"),
    ("51-5100", "Printing Workers"),
    ("51-6000", "Textile, Apparel, and Furnishings Workers"),
    ("51-7000", "Woodworkers"),
    ("51-8000", "Plant and System Operators"),
    ("51-9000", "Other Production Occupations"),
    ("53-1000", "Supervisors of Transportation and Material Moving Workers"),
    ("53-2000", "Air Transportation Workers"),
    ("53-3000", "Motor Vehicle Operators"),
    ("53-4000", "Rail Transportation Workers"),
    ("53-5000", "Water Transportation Workers"),
    ("53-6000", "Other Transportation Workers"),
    ("53-7000", "Material Moving Workers"),
    ("55-1000", "Military Officer Special and Tactical Operations Leaders"),
    ("55-2000", "First-Line Enlisted Military Supervisors"),
    ("55-3000", "Military Enlisted Tactical Operations and Air/Weapons Specialists and Crew Members"),
)

# ---------------------------------------------------------------------------
# NAICS 2-digit sectors (naics_2d, sector, short_sector).
# ---------------------------------------------------------------------------
SECTORS = (
    ("11", "Agriculture, Forestry, Fishing and Hunting", "Agriculture"),
    ("21", "Mining, Quarrying, and Oil and Gas Extraction", "Mining"),
    ("22", "Utilities", "Utilities"),
    ("23", "Construction", "Construction"),
    ("31", "Manufacturing", "Manufacturing"),
    ("42", "Wholesale Trade", "Wholesale"),
    ("44", "Retail Trade", "Retail"),
    ("48", "Transportation and Warehousing", "Logistics"),
    ("51", "Information", "Information"),
    ("52", "Finance and Insurance", "Finance"),
    ("53", "Real Estate and Rental and Leasing", "Real Estate"),
    ("54", "Professional, Scientific, and Technical Services", "Professional"),
    ("55", "Management of Companies and Enterprises", "Management"),
    ("56", "Administrative and Support and Waste Management and Remediation Services", "Administrative"),
    ("61", "Educational Services", "Education"),
    ("62", "Health Care and Social Assistance", "Health Care"),
    ("71", "Arts, Entertainment, and Recreation", "Arts/Entertainment"),
    ("72", "Accommodation and Food Services", "Hospitality"),
    ("81", "Other Services (except Public Administration)", "Other Services"),
    ("92", "Public Administration", "Public Administration"),
    ("99", "Industries not classified", "Industries not classified"),
)

# ---------------------------------------------------------------------------
# Census CITIZEN codes and labels (codebook value labels).
# ---------------------------------------------------------------------------
CITIZEN_LABELS = (
    (0, "N/A"),
    (1, "Born abroad of American parents"),
    (2, "Naturalized citizen"),
    (3, "Not a citizen"),
    (4, "Not a citizen, but has received first papers"),
    (5, "Foreign born, citizenship status not reported"),
)


def soc_structure_minor(spark: SparkSession) -> DataFrame:
    """Minor-group rows of the occupation structure (``minor_group, title``)."""
    return spark.createDataFrame(list(SOC_MINOR_GROUPS), "minor_group string, title string")


def sector_titles(spark: SparkSession) -> DataFrame:
    """Sector titles dimension (``naics_2d, sector, short_sector``)."""
    return spark.createDataFrame(list(SECTORS), "naics_2d string, sector string, short_sector string")


def citizen_labels(spark: SparkSession) -> DataFrame:
    """Codebook value labels of ``CITIZEN`` (``name, value, label``)."""
    rows = [("CITIZEN", v, lab) for v, lab in CITIZEN_LABELS]
    return spark.createDataFrame(rows, "name string, value int, label string")
