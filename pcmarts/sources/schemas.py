"""Bronze schemas (DDL). Dates and timestamps arrive as ISO text; money arrives as DOUBLE."""

# Column names and types of the landed tables.
SCHEMAS: dict[str, str] = {
    "geography": "geo_id string, state_code string, state_name string, region string, zip_code string, cresta_zone string, "
                 "latitude double, longitude double, country string, windstorm_zone bigint, flood_zone string",
    "customers": "customer_id string, customer_name string, customer_type string, email string, phone string, "
                 "date_of_birth string, geo_id string, income_bracket string, credit_score bigint, loyalty_tier string, "
                 "marketing_consent boolean, signup_date string",
    "agents": "agent_id string, agent_name string, channel string, license_state string, specialty_lob string, "
              "ytd_commission_usd double, hire_date string, active boolean",
    "policies": "policy_id string, customer_id string, geo_id string, agent_id string, line_of_business string, "
                "product string, policy_status string, channel string, effective_date string, expiration_date string, "
                "annual_premium_usd double, sum_insured_usd double, deductible_usd double, policy_term_months bigint, "
                "currency string, reinsured boolean, underwriter_score double",
    "premiums": "premium_id string, policy_id string, line_of_business string, product string, billing_month string, "
                "gross_premium_usd double, commission_usd double, tax_usd double, paid boolean, "
                "ceded_to_reinsurance_usd double",
    "claims": "claim_id string, policy_id string, line_of_business string, product string, peril string, geo_id string, "
              "loss_date string, report_date string, claim_status string, incurred_amount_usd double, "
              "paid_amount_usd double, reserve_amount_usd double, salvage_recovery_usd double, "
              "subrogation_recovery_usd double, fraud_flag boolean, catastrophe_code string",
    "reinsurance_treaties": "treaty_id string, treaty_type string, reinsurer string, line_of_business string, "
                            "cession_pct double, limit_usd double, retention_usd double, premium_ceded_usd double, "
                            "treaty_start string, treaty_end string, active boolean",
    "asset_portfolio": "asset_id string, asset_class string, rating string, issuer string, currency string, "
                       "market_value_usd double, book_value_usd double, duration_yrs double, yield_pct double, "
                       "purchase_date string, maturity_date string, esg_score double",
    "weather_obs": "observation_id string, city string, cresta_zone string, latitude double, longitude double, "
                   "observed_time_utc string, temperature_f double, wind_speed_mph double, wind_gust_mph double, "
                   "precipitation_in double, rain_in double, weather_code bigint, pressure_mb double, humidity_pct double, "
                   "fetched_at_utc string, source string",
    "earthquakes": "event_id string, event_type string, magnitude double, place string, longitude double, latitude double, "
                   "depth_km double, event_time_utc string, url string, severity string, fetched_at_utc string, source string",
    "catastrophe_events": "event_id string, title string, description string, event_type string, severity string, "
                          "latitude double, longitude double, event_time_utc string, link string, fetched_at_utc string, "
                          "source string",
    "noaa_alerts": "alert_id string, event_type string, severity string, certainty string, urgency string, "
                   "area_desc string, headline string, sent_utc string, effective_utc string, expires_utc string, "
                   "fetched_at_utc string, source string",
    "news": "news_id string, title string, summary string, published_utc string, link string, category string, "
            "fetched_at_utc string, source string",
}

# Feed folder -> (bronze table, key column)
FEEDS: dict[str, tuple[str, str]] = {
    "weather": ("weather_obs", "observation_id"),
    "earthquakes": ("earthquakes", "event_id"),
    "catastrophes": ("catastrophe_events", "event_id"),
    "noaa_alerts": ("noaa_alerts", "alert_id"),
    "news": ("news", "news_id"),
}

# The raw answers of the feeds before parsing; ``request`` names what was asked for (the city, for weather).
RAW_PAYLOAD = "feed string, request string, fetched_at_utc string, status int, payload string"
