-- Quality of the rides of one day, one row per check.  :most_missing is the largest share of rides without a session.
WITH ride AS (SELECT * FROM ride_base WHERE date_kr = :target_date),
measured AS (
  SELECT count(*) AS rides,
         count(DISTINCT ride_id) AS ids,
         count_if(is_valid_5_last IS NULL) AS without_session,
         count_if(credit_withdrawal_amount < 0) AS negative_credit
  FROM ride
),
checked AS (
  SELECT stack(4,
    'rides loaded', rides, rides > 0,
    'distinct ride ids', ids, ids = rides,
    'rides without a session', without_session, without_session <= :most_missing * rides,
    'negative credit', negative_credit, negative_credit = 0) AS (check_name, observed, passed)
  FROM measured
)
SELECT :target_date AS date_kr, check_name, observed, passed FROM checked
