"""Tiny hand-written Bronze tables in the race-data schema, dirt included."""

N = "\\N"


def bronze_tables(spark):
    t = {}
    t["race_data_circuits"] = spark.createDataFrame(
        [(1, "albert_park", " Albert Park ", "Melbourne", "Australia", -37.8, 144.9, 10, "http://x/1"),
         (2, "silverstone", "Silverstone", " Silverstone", "UK", 52.07, -1.01, 153, "http://x/2"),
         (3, "yas", "Yas Marina", "Abu Dhabi", "UAE", 24.4, 54.6, 3, "http://x/3")],
        "circuitid int, circuitref string, name string, location string, country string, lat double, lng double, alt int, url string",
    )
    t["race_data_drivers"] = spark.createDataFrame(
        [(1, "ham", "44", "HAM", " Lewis", "Hamilton ", "1985-01-07", "British", "u"),
         (2, "ver", N, "VER", "Max", "Verstappen", "9/30/97", "Dutch", "u"),
         (3, "old", N, N, "Old", "Timer", "10/24/31", "British", "u")],
        "driverid int, driverref string, number string, code string, forename string, surname string, dob string, nationality string, url string",
    )
    t["race_data_constructors"] = spark.createDataFrame(
        [(10, "mercedes", "Mercedes ", "German", "u"), (20, "red_bull", "Red Bull", "Austrian", "u")],
        "constructorid int, constructorref string, name string, nationality string, url string",
    )
    races_schema = ("raceid int, year int, round int, circuitid int, name string, date string, time string, "
                    "fp1_date string, fp1_time string, fp2_date string, fp2_time string, fp3_date string, fp3_time string, "
                    "quali_date string, quali_time string, sprint_date string, sprint_time string, url string")
    t["race_data_races"] = spark.createDataFrame(
        [(100, 2024, 1, 1, "Australian Grand Prix", "2024-03-24", "04:00:00Z", "2024-03-22", "01:30:00", N, N, N, N, "2024-03-23", "05:00:00", N, N, "u"),
         (101, 2024, 2, 2, "British Grand Prix", "2024-07-07", "14:00:00", N, N, N, N, N, N, N, N, "2024-07-06", "10:30:00.000", "u"),
         (102, 2024, 3, 2, "British Grand Prix", "2024-08-11", N, N, N, N, N, N, N, N, N, N, N, "u"),
         (103, 2024, 4, 3, "Abu Dhabi Grand Prix", "2024-12-08", "13:00:00", N, N, N, N, N, N, N, N, N, N, "u")],
        races_schema,
    )
    t["race_data_status"] = spark.createDataFrame([(1, "Finished"), (2, "Engine")], "statusid int, status string")
    res_schema = ("resultid int, raceid int, driverid int, constructorid int, number string, grid string, position string, "
                  "positiontext string, positionorder int, points double, laps int, time string, milliseconds string, "
                  "fastestlap string, rank string, fastestlaptime string, fastestlapspeed string, statusid int")
    t["race_data_results"] = spark.createDataFrame(
        [(1, 100, 1, 10, "44", "1", "1", "1", 1, 25.0, 58, "1:20:00", "5000000", "50", "1", "1:27.452", "220.1", 1),
         (2, 100, 2, 20, "1", "0", N, "R", 2, 0.0, 30, N, N, N, N, N, N, 2),
         (3, 101, 1, 10, "44", "3", "2", "2", 2, 18.0, 52, "+1.0", "5100000", "40", "2", "1:31.5", "210.0", 1),
         (4, 103, 2, 20, "1", "2", "1", "1", 1, 25.0, 58, "1:30:00", "5200000", "44", "1", "83", "199.9", 1)],
        res_schema,
    )
    t["race_data_pit_stops"] = spark.createDataFrame(
        [(100, 1, 1, 20, "14:20:00Z", "23.456", "23456"), (100, 1, 2, 40, "14:50:00", "1:02.345", "62345"),
         (101, 1, 1, 25, "15:00:00", "83", "83000")],
        "raceid int, driverid int, stop int, lap int, time string, duration string, milliseconds string",
    )
    t["race_data_driver_standings"] = spark.createDataFrame(
        [(100, 1, 25.0, "1", "1", 1), (100, 2, 0.0, N, "-", 0)],
        "raceid int, driverid int, points double, position string, positiontext string, wins int",
    )
    t["race_data_constructor_standings"] = spark.createDataFrame(
        [(100, 10, 25.0, "1", "1", 1), (101, 10, 43.0, "1", "E", 1)],
        "raceid int, constructorid int, points double, position string, positiontext string, wins int",
    )
    t["race_data_lap_times"] = spark.createDataFrame(
        [(100, 1, 1, "1", "1:30.1", "90100"), (100, 1, 2, "1", "1:29.9", "89900")],
        "raceid int, driverid int, lap int, position string, time string, milliseconds string",
    )
    t["race_data_qualifying"] = spark.createDataFrame(
        [(100, 1, 10, "44", "1", "1:26.5", "59.9", N), (100, 2, 20, "1", "2", "1:27.0", N, N)],
        "raceid int, driverid int, constructorid int, number string, position string, q1 string, q2 string, q3 string",
    )
    t["race_data_sprint_results"] = spark.createDataFrame(
        [(101, 1, 10, "44", "2", "1", "1", 1, 8.0, 17, "30:00", "1800000", "10", "1", "1:35.0", 1)],
        "raceid int, driverid int, constructorid int, number string, grid string, position string, positiontext string, "
        "positionorder int, points double, laps int, time string, milliseconds string, fastestlap string, rank string, "
        "fastestlaptime string, statusid int",
    )
    t["race_events_safety_cars"] = spark.createDataFrame(
        [("Australian Grand Prix", "Accident/Debris", 3, 5.0, 2), ("British Grand Prix", " Rain ", 10, 12.0, 1)],
        "race string, cause string, deployed int, retreated double, fulllaps int",
    )
    t["race_events_red_flags"] = spark.createDataFrame(
        [("British Grand Prix", 12, "Heavy rain", "R", "-"), ("Abu Dhabi Grand Prix", 1, "Crash", N, "Max")],
        "race string, lap int, incident string, resumed string, excluded string",
    )
    t["race_events_fatal_accidents_drivers"] = spark.createDataFrame(
        [("Some Driver", 30, "10/24/71", "Race X", "Car A", "Race")],
        "driver string, age int, date_of_accident string, event string, car string, session string",
    )
    t["race_events_fatal_accidents_marshalls"] = spark.createDataFrame(
        [("Some Marshal", 40, "6/7/52", "Race Y")],
        "name string, age int, date_of_accident string, event string",
    )
    return t
