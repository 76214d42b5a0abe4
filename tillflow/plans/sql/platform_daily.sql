-- Order counts and units per platform and day.
SELECT platform,
       to_date(date_time) AS date,
       count(*) AS line_count,
       sum(quantity) AS units
FROM {deposits}
WHERE to_date(date_time) BETWEEN :start_date AND :end_date
GROUP BY platform, to_date(date_time)
